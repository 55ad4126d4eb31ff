import zlib

import pandas as pd

from shelfrank.llm.sharding import jump_shards, op7_jump_shards, shard
from pyspark.sql import functions as F

from edge_data import SF as SF_SMALL


def jump(key, n):
    key &= (1 << 64) - 1
    b, j = -1, 0
    while j < n:
        b = j
        key = (key * 2862933555777941757 + 1) & ((1 << 64) - 1)
        j = int((b + 1) * (float(1 << 31) / float((key >> 33) + 1)))
    return b


def test_jump_equals_the_published_loop(spark):
    keys = [*range(-30, 300), 2 ** 62 + 7, -2 ** 63, 2 ** 63 - 1]
    for n in (1, 2, 40):
        got = spark.createDataFrame([(k,) for k in keys], "k long").select("k", jump_shards(F.col("k"), n).alias("j")).collect()
        assert all(r.j.shard == jump(r.k, n) and r.j.grown == jump(r.k, n + 1) for r in got)


def test_query_on_a_whole_table(spark):
    docs = pd.read_parquet(f"{SF_SMALL}/documents.parquet").set_index("doc_id").text
    got = op7_jump_shards(spark, SF_SMALL).toPandas()
    assert sorted(got.doc_id) == sorted(docs.index)
    for r in got.itertuples():
        raw = docs[r.doc_id].encode()
        assert (r.size, r.text_crc32, r.shard, r.grown_shard) == (len(raw) + 16, zlib.crc32(raw), jump(r.doc_id, 40), jump(r.doc_id, 41))
        assert r.grown_shard in (r.shard, 40)
    for _, g in got.groupby("shard"):
        assert sorted(g.slot) == list(range(len(g)))


def test_edges(edges, nothing):
    got = shard(edges, "doc_id", 7, blocks=2).select("doc_id", "shard", "slot").toPandas()
    assert len(got) == edges.count()
    assert (got[got.doc_id.isna()]["shard"] == jump(0, 7)).all()
    for _, g in got.groupby("shard"):
        assert sorted(g.slot) == list(range(len(g)))
    assert shard(nothing, "doc_id", 7).count() == 0
