"""Licences with a named holder, short notices and header identifiers."""

import pytest

from tidemark.llm import license_scan

BSD = """Redistribution and use in source and binary forms, with or without
modification, are permitted provided that the following conditions are met:

1. Redistributions of source code must retain the above copyright notice, this
   list of conditions and the following disclaimer.
2. Redistributions in binary form must reproduce the above copyright notice,
   this list of conditions and the following disclaimer in the documentation
   and/or other materials provided with the distribution.
"""
NAMES = "{} nor the names of its\n   contributors may be used to endorse or promote products derived from\n   this software without specific prior written permission."
CASES = [
    (BSD, ["BSD-2-Clause"]),
    (BSD + "3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission.", ["BSD-3-Clause"]),
    *((BSD + "3. " + NAMES.format(f"Neither the name of {n}"), ["BSD-3-Clause"]) for n in ("Example Inc.", "the University of\n   Somewhere", "the <ORGANIZATION>", "A. N. Other, Ltd.")),
    (BSD + "3. The name of the author may not be used to endorse or promote products\n   derived from this software without specific prior written permission.", ["BSD-3-Clause"]),
    ("// SPDX-License-Identifier: MIT\nint x;", ["MIT"]), ("# SPDX-License-Identifier: GPL-2.0-or-later\n", ["GPL-2.0"]), ("SPDX-License-Identifier: Apache-2.0", ["Apache-2.0"]), ("SPDX-License-Identifier: Unknown-1.0", []),
    ("It is distributed under the terms of the MIT License.", []), ("Distributed under the terms of the MIT License.", ["MIT"]), ("Licensed under the Apache License 2.0.", ["Apache-2.0"]), ("Licensed under the Mozilla Public License 2.0.", ["MPL-2.0"]),
    ("Neither the name of the thing nor the names of others matter here.", []),
]


def test_named_holders_notices_and_identifiers(make):
    rows = [(i, t) for i, (t, _) in enumerate(CASES)]
    got = {r["doc_id"]: r["licenses"] for r in license_scan.scan(make(rows)).collect()}
    assert got == {i: want for i, (_, want) in enumerate(CASES)}


@pytest.mark.parametrize("name", ["op2_license_scan", "op11_source_audit", "op12_resample"])
def test_sql_agrees(spark, name):
    import duckdb

    from tidemark.llm import queries

    sf = "/root/testdata/sf0.001"
    con = duckdb.connect()
    for table in ("documents", "benchmark"):
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{sf}/{table}.parquet'")
    df = queries.queries()[name](spark, sf)
    cursor = con.execute(queries.oracle_sql()[name])
    columns = [d[0] for d in cursor.description]
    assert sorted(columns) == sorted(df.columns)
    assert sorted((tuple(r[c] for c in columns) for r in df.collect()), key=repr) == sorted(cursor.fetchall(), key=repr)
