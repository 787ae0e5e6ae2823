"""Licence texts as they are distributed: wrapped before capitals, in comments, below a title."""

from tidemark.llm import license_scan

MIT = '''MIT License
Copyright (c) 2020 Somebody
Permission is hereby granted, free of charge, to any person obtaining a copy
of this software and associated documentation files (the "Software"), to deal
in the Software without restriction, including without limitation the rights
to use, copy, modify, merge, publish, distribute, sublicense, and/or sell
copies of the Software, and to permit persons to whom the Software is
furnished to do so, subject to the following conditions:

The above copyright notice and this permission notice shall be included in all
copies or substantial portions of the Software.

THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR
IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY,
FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE
AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM.
'''
GPL = '''This program is free software{0} you can redistribute it and/or modify
it under the terms of the GNU {1}General Public License as published by
the Free Software Foundation{2} either version {3} of the License, or
(at your option) any later version.
'''
MPL = '''This Source Code Form is subject to the terms of the Mozilla Public
License, v. 2.0. If a copy of the MPL was not distributed with this
file, You can obtain one at https://mozilla.org/MPL/2.0/.
'''


def commented(text, mark):
    return "".join(f"{mark} {line}".rstrip() + "\n" for line in text.splitlines())


def test_verbatim_texts(make):
    cases = [(MIT, ["MIT"])] + [(commented(MIT, m), ["MIT"]) for m in ("#", "//", " *")] + [(MIT.replace("\n", "\r\n"), ["MIT"])]
    cases += [
        (GPL.format(":", "", ",", "3"), ["GPL-3.0"]), (GPL.format(";", "", ";", "2"), ["GPL-2.0"]), (commented(GPL.format(";", "Lesser ", ";", "2.1"), "#"), ["LGPL-2.1"]),
        (GPL.format(":", "Lesser ", ",", "3"), ["LGPL-3.0"]), (GPL.format(":", "Affero ", ",", "3"), ["AGPL-3.0"]), (MPL, ["MPL-2.0"]), (commented(MPL, "//"), ["MPL-2.0"]),
        ("This is free and unencumbered software released into the public domain.\n", ["Unlicense"]), ("This file is licensed under the Apache License, Version 2.0.", ["Apache-2.0"]),
        ("    GNU GENERAL PUBLIC LICENSE\n       Version 2, June 1991\n", ["GPL-2.0"]), ("Released under the\n\nMIT License.", []), ("This is not released under the MIT License.", []),
    ]
    got = {r["doc_id"]: r["licenses"] for r in license_scan.scan(make([(i, t) for i, (t, _) in enumerate(cases)])).collect()}
    assert got == {i: want for i, (_, want) in enumerate(cases)}
