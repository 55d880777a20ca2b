import pytest
from helpers import words
from pyspark.sql import functions as F

from fettle.llm import common, exchange, substrings


def rows_of(total, batch=4_000, bucket=8_000, row=1_000):
    a, b = exchange.sizes_for(total, batch, bucket, row)
    return total / a * total / b


def test_exchange_rows_grow_in_proportion():
    assert exchange.sizes_for(10**6) == (exchange.BATCH_BYTES, exchange.BUCKET_BYTES)
    at = [rows_of(n * 100_000) for n in (1, 4, 16, 1_000_000)]
    assert all(b / a == pytest.approx(n, rel=0.01) for a, b, n in zip(at, at[1:], (4, 4, 62_500), strict=False))
    assert rows_of(10**14, exchange.BATCH_BYTES, exchange.BUCKET_BYTES) <= 10**14 / exchange.ROW_BYTES


@pytest.mark.parametrize("row_bytes", [1, 300, 5_000])
def test_written_exchange_rows(spark, monkeypatch, row_bytes):
    """Batches times buckets of texts of 1, 4 and 16 times as many rows."""
    least = exchange.sizes_for
    monkeypatch.setattr(
        exchange, "sizes_for", lambda total, batch_bytes=2_000, bucket_bytes=2_000: least(total, batch_bytes, bucket_bytes, row_bytes)
    )
    made = []
    for n in (100, 400, 1600):
        docs = spark.createDataFrame([(i, words(i, 40)) for i in range(n)], "doc_id long, text string").coalesce(1)
        total = docs.agg(F.sum(F.octet_length("text"))).first()[0]
        batches = exchange.batched(docs, 2_000).count()
        buckets = total / exchange.sizes_for(total, 2_000, 2_000)[1]
        made.append(batches * buckets)
    if row_bytes == 5_000:
        assert made[1] < 5 * made[0] and made[2] < 5 * made[1]
    if row_bytes == 1:
        assert made[2] > 12 * made[1]


def test_larger_batches_give_the_same_spans(spark, monkeypatch):
    rows = [(i, words(i % 40, 60 + i % 7)) for i in range(200)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    want = sorted(map(str, substrings.remove_repeats(docs, batch_bytes=1_000).collect()))
    least = exchange.sizes_for
    monkeypatch.setattr(exchange, "sizes_for", lambda total, batch_bytes=1_000, bucket_bytes=1_000: least(total, batch_bytes, bucket_bytes, 5_000))
    assert sorted(map(str, substrings.remove_repeats(docs, batch_bytes=1_000).collect())) == want


def test_rank_blocks_follow_the_size_and_leave_ranks_alone(spark, monkeypatch):
    assert common.rank_bits(0) == common.rank_bits(1000) == common.RANK_BITS
    assert 10**12 / 2 ** common.rank_bits(10**12) <= common.RANK_ROWS
    # A third of the rows in one group, and rows that are equal.
    df = spark.range(3000).select(F.when(F.col("id") % 3 == 0, -1).otherwise(F.col("id") % 5).alias("g"), (F.col("id") % 1500).alias("v"))
    found = []
    for bits, size in ((1, 10**9), (4, 10**9), (1, 10)):
        monkeypatch.setattr(common, "RANK_BITS", bits)
        monkeypatch.setattr(common, "RANK_ROWS", size)
        found.append(sorted(map(tuple, common.with_rank(df, "g", ["v"], "r").collect())))
    assert found[0] == found[1] == found[2]
    for g in {r[0] for r in found[0]}:
        ranks = sorted(r[2] for r in found[0] if r[0] == g)
        assert ranks == list(range(len(ranks)))
    assert len(found[0]) == 3000
