"""Operations of a training-data pipeline, one module each, and the queries that apply them."""
