"""Rows that every operator must handle."""

SF = "/root/testdata/sf0.001"
LONG = "".join(f"word{i % 977} tail{i % 331}.\n" if i % 9 == 0 else f"word{i % 977} " for i in range(30_000))

# doc_id, text: nulls, empties, white space, a very long text, ties, repeated rows, no doc_id
EDGES = [(1, "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu"), (2, None), (3, ""), (4, " \n\t "),
         (5, LONG), (6, LONG + "end"), (7, "one"), (8, "One"),
         (1, "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu"),
         (None, "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu"),
         (9, "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu"),
         (10, "é日本😀 ▁ \x00 ñ"), (None, None)]
DOCUMENTS = "doc_id long, text string, lang string, source string, n_chars long"
EXTRA = DOCUMENTS + (", score double, ids string, base int, added int, shard int, slot int, _runs int, _gone int, _doc int, "
                     "_n int, at int, code int, h int, features int, round_trip int, component_id int, kept int")


def documents(spark, rows=EDGES, schema=DOCUMENTS):
    extra = len(schema.split(",")) - 5
    return spark.createDataFrame([(d, t, "en", "s", None if t is None else len(t), *([None] * extra)) for d, t in rows], schema)
