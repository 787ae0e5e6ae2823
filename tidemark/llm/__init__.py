"""Operations of a training-data pipeline over whole corpora. Nothing outside this package imports it."""
