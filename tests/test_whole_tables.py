"""Queries over tables whose ids go beyond those of the smallest tables."""

from millrace.operators import dedupe
from millrace.plans import core, relational  # noqa: F401

MANY = 2654435761


def test_near_pairs_by_bands_of_all_events(spark, tmp_path):
    back = pow(MANY, -1, 1 << 20)
    hashes = sorted({h ^ (1 << b) for h in (0, 77, 4095, 654_321, 1_048_575) for b in range(0, 20, 3)} | {0, 77, 4095, 654_321, 1_048_575, 1000, 2000})
    events = [(2 * (h * back % (1 << 20) + k * (1 << 20)) + k % 2, 3 * h + k % 3) for h in hashes for k in (0, 1, 4)]
    spark.createDataFrame(events, "event_id long, user_id long").write.parquet(f"{tmp_path}/events.parquet")
    rows = [(i, u % 3, 2 * (i // 2 * MANY % (1 << 20)) + i % 2) for i, u in events]
    want = {(s, a, b) for a, s, h in rows for b, z, g in rows if s == z and a < b and (h ^ g).bit_count() <= 1}
    assert any(a >= 4000 for _, a, _ in want)
    got = core.QUERIES["j08_near_pairs_by_bands"](spark, str(tmp_path)).collect()
    assert len(got) == len(want) and {(r.scope, r.a, r.b) for r in got} == want


def test_bands_share_one(spark):
    pairs = [(0, 0b11), (-1, (1 << 63) - 1), (5, 5 | 1 << 40), (1 << 20, 7 + (1 << 20)), (-(1 << 63), 1)]
    for most in (1, 2, 7):
        df = spark.createDataFrame(pairs, "a long, b long")
        for r in df.select("a", "b", dedupe.bands(df.a, most).alias("x"), dedupe.bands(df.b, most).alias("y")).collect():
            assert bool(set(r.x) & set(r.y)) or ((r.a ^ r.b) & (2**64 - 1)).bit_count() > most
    # Short hashes: no band is the same in all rows.
    short = spark.range(1024).withColumn("x", dedupe.bands(dedupe.col("id"), 1))
    assert short.selectExpr("count(distinct x[0].bits) as p", "count(distinct x[1].bits) as q").first()[:] == (32, 32)


def test_sites_of_all_suppliers(spark, tmp_path):
    keys = [1, 7, 14, 39, 40, 41, 42, 43, 44, 45, 49, 1000, 123_456]
    spark.createDataFrame([(k, f"S{k}") for k in keys], "s_suppkey long, s_name string").write.parquet(f"{tmp_path}/supplier.parquet")
    spark.createDataFrame([(0, "A"), (1, "B")], "n_nationkey long, n_name string").write.parquet(f"{tmp_path}/nation.parquet")
    kind = lambda k: ["html", "api", "commons", "gbif", "ftp"][k % 5]
    on = [k for k in keys if k % 7 and kind(k) != "ftp"]
    pages = {(f"S{k}", p) for k in on for p in range(1, max(1, k % 3) + 1)}

    def rows(name):
        got = [tuple(r) for r in core.QUERIES[name](spark, str(tmp_path)).collect()]
        assert len(got) == len(set(got))
        return set(got)

    assert rows("s18_sites") == {(f"S{k}", kind(k), False if k % 7 == 0 else True if k % 2 == 0 else None, k % 3) for k in keys}
    assert rows("f07_enabled_sites") == {(f"S{k}", kind(k)) for k in on}
    assert rows("j09_keyword_sites_pages") == {(n, s, p) for n in "AB" for s, p in pages}
    assert rows("w08_page_offsets") == {(s, p, (p - 1) * 35) for s, p in pages}
