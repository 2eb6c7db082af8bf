"""Documents that every operator has to take: nulls, empty and long texts, ties, repeated rows, odd columns."""

ODD = [
    (1, "The cat sat on the mat. " * 40), (2, "The cat sat on the mat. " * 40), (2, "The cat sat on the mat. " * 40),
    (3, None), (4, ""), (5, "  \n\t "), (None, "no id here, only a few words"), (None, None), (6, "été 日本語 " * 300),
    (7, "a" * 30000), (8, "x y " * 20000), (9, "One two three four five six seven eight nine ten eleven."), (9, "another text, same id"),
    (10, "line\nline\n\nline\n### $$$ %%% ||| <a>"), (11, "don't we'll I'm they've 'tis 12345 !!! ...   \n\n  end  "),
    (12, "\x00zero\x0bvt\x0cff\x85nel em"),
]


def odd_docs(spark, rows=ODD):
    """The rows with extra columns whose names clash with results and helpers."""
    df = spark.createDataFrame([(*r, i, "s", 1.5) for i, r in enumerate(rows)],
                               "doc_id bigint, text string, n_words int, ids string, __in0 double")
    return df.repartition(3)


def by_id(rows, key="doc_id"):
    return sorted((tuple(r) for r in rows), key=lambda t: tuple((x is None, str(x)) for x in t))


def texts(con_path):
    import duckdb
    return duckdb.connect().execute(f"SELECT doc_id, text FROM '{con_path}/documents.parquet' ORDER BY doc_id").fetchall()


def tiktoken_encoding():
    import base64
    import public_tokenizers as P
    import tiktoken
    with open(P.path("byte_bpe_50k.tiktoken"), "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})
