"""Unit and property tests of the core operators."""

import itertools
import random
import struct
import unicodedata
import uuid
import zlib

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from millrace.functions import columns as C
from millrace.functions import imaging as I
from millrace.functions import ontology as O
from millrace.operators import dedupe, ingest, merge, review, samples, verify
from millrace.operators import greedy as greedy_pass
from millrace.operators.order import places
from millrace.operators.runs import first_rows, pruned
from millrace.shared import shared_folder
from millrace.sources import files as S
from millrace.sources import markup as S_markup
from millrace.sources import sinks as K


def one(spark, column):
    return spark.range(1).select(column.alias("x")).first().x


@pytest.mark.parametrize(
    ("raw", "want"),
    [
        ("Apple___healthy", "Apple leaf"), ("Corn_(maize)___Common_rust_", "Corn rust leaf"), ("Tomato___Leaf_Mold", "Tomato mold leaf"), ("Grape___healthy", "grape leaf"),
        ("Grape___Esca_(Black_Measles)", "grape leaf black measles"), ("Soybean___healthy", "Soyabean leaf"), ("Pepper,_bell___Bacterial_spot", "Bell_pepper leaf spot"),
        ("Strawberry___Leaf_scorch", "Strawberry Leaf scorch"), ("Cherry_(including_sour)___Powdery_mildew", "Cherry Powdery mildew leaf"), ("rice", "rice"), ("A___b___c", "A b c leaf"),
        ("Orange___Haunglongbing_(Citrus_greening)", "Orange citrus greening leaf"), ("Tomato___Spider_mites Two-spotted_spider_mite", "Tomato two spotted spider mites leaf"),
    ],
)
def test_normal_class(spark, raw, want):
    assert one(spark, C.normal_class(F.lit(raw))) == want


def test_health_quirks(spark):
    names = ["Carrot leaf", "Orange citrus greening leaf", "grape leaf black measles", "termite", "Apple leaf", " Apple LEAF ", "Apple Scab Leaf"]
    df = spark.createDataFrame([(n,) for n in names], "n string").select(C.is_healthy(F.col("n")), C.disease_of(F.col("n")))
    assert [tuple(r) for r in df.collect()] == [(False, "Carrot leaf"), (True, None), (False, None), (False, "termite"), (True, None), (True, None), (False, "Apple Scab Leaf")]


def test_ontology_sizes():
    assert len(O.CLASS_NAMES) == 113 and len(set(O.CLASS_NAMES.values())) == 83
    assert len(O.CROP_ZH) == 45 and len(O.DISEASE_TOKENS) == 12 and len(O.CLASS_MAP) == 17


@settings(max_examples=15, deadline=None)
@given(st.lists(st.text(max_size=30), min_size=1, max_size=20))
def test_uuid5(spark, names):
    rows = spark.createDataFrame([(n.replace("\x00", ""),) for n in names], "n string").select("n", C.uuid5_hex(F.col("n")).alias("u")).collect()
    assert all(r.u == uuid.uuid5(uuid.NAMESPACE_URL, r.n).hex for r in rows)


def test_fold_and_source_class(spark):
    for s in ("Açaí plant", "Ñandú  ﬁg", "Ångström½"):
        assert one(spark, C.fold_ascii(F.lit(s))) == unicodedata.normalize("NFKD", s).encode("ascii", "ignore").decode()
    assert one(spark, C.source_class(F.lit("  Açaí  PLANT "))) == "Acai"


@settings(max_examples=10, deadline=None)
@given(st.lists(st.integers(1, 60), min_size=1, max_size=5), st.sampled_from([(0.8, 0.1, 0.1), (0.29, 0.01, 0.7), (1.0, 0.0, 0.0)]))
def test_split_counts(spark, sizes, ratios):
    rows = [(f"d{i}", f"d{i}/{k}") for i, n in enumerate(sizes) for k in range(n)]
    got = samples.with_split(spark.createDataFrame(rows, "dir string, path string"), ratios=ratios).groupBy("dir", "split").count().collect()
    n = {(r.dir, r.split): r["count"] for r in got}
    for i, size in enumerate(sizes):
        train, val = int(size * ratios[0]), int(size * ratios[1])
        assert [n.get((f"d{i}", s), 0) for s in ("train", "val", "test")] == [train, val, size - train - val]


def test_ratios_must_sum_to_one():
    with pytest.raises(ValueError):
        samples.check_ratios((0.8, 0.1, 0.2))


def test_sample_fan_out_and_json(spark, tmp_path):
    rows = [(f"datasets/{r}/{c}/{c}__kd__1.jpg", r, c, "d") for r, c in [("diseases", "Apple leaf"), ("diseases", "Apple Scab Leaf"), ("diseases", "x y"), ("crops", "rice"), ("pests", "moth"), ("other", "moth")]]
    out = samples.build_samples(spark.createDataFrame(rows, "path string, root string, class_raw string, dir string"), samples.class_table(spark))
    n = {(r.image.split("/")[1], r.image.split("/")[2]): r["count"] for r in out.groupBy("image").count().collect()}
    assert n == {("diseases", "Apple leaf"): 6, ("diseases", "Apple Scab Leaf"): 6, ("diseases", "x y"): 5, ("crops", "rice"): 4, ("pests", "moth"): 4, ("other", "moth"): 4}
    K.write_samples(out, f"{tmp_path}/all")
    K.write_samples(out, f"{tmp_path}/by", by_split=True)
    lines = [r.value for r in spark.read.text(f"{tmp_path}/all").collect()]
    assert len(lines) == 29 and spark.read.text(f"{tmp_path}/by").count() == 29
    ill = next(x for x in lines if "A healthy Apple leaf." in x)
    assert '"disease":null' in ill and '"answer"' not in ill and '"pest"' not in ill
    assert '"disease"' not in next(x for x in lines if "A photo of rice." in x)


def greedy(rows, most):
    kept = {}
    for scope, key, h in sorted(rows):
        near = kept.setdefault(scope, [])
        if not any((h ^ x).bit_count() <= most for _, x in near):
            near.append((key, h))
    return {(s, k) for s, v in kept.items() for k, _ in v}


@pytest.mark.parametrize(("whole", "bucket"), [(65_536, 65_536), (6, 5)])
@pytest.mark.parametrize("most", [0, 3, 7, 9, 22])
def test_greedy_near_duplicates(spark, monkeypatch, most, whole, bucket):
    """Whole scopes in a task, and rounds over scopes and buckets that are too large for one."""
    monkeypatch.setattr(greedy_pass, "WHOLE", whole)
    monkeypatch.setattr(greedy_pass, "BUCKET", bucket)
    monkeypatch.setattr(greedy_pass, "HEAD", 4)
    monkeypatch.setattr(greedy_pass, "SHARE", 16)
    rnd = random.Random(most)
    base = [rnd.getrandbits(64) for _ in range(8)]
    rows = []
    for i in range(150):
        h = rnd.choice(base)
        for _ in range(rnd.randint(0, 4)):
            h ^= 1 << rnd.randrange(64)
        rows.append((f"s{i % 2}", f"f{i:03d}", h if i % 5 else rnd.getrandbits(64)))
    signed = [(s, k, h - 2**64 if h >= 2**63 else h) for s, k, h in rows]
    got = dedupe.near_duplicates(spark.createDataFrame(signed, "scope string, rank_key string, hash long"), most).select("scope", "rank_key").collect()
    assert {tuple(r) for r in got} == greedy(rows, most)


def test_random_hashes_and_a_dense_cluster_in_one_scope(spark):
    """300,000 hashes at 22 bits, of which few stay, and all of a ball of three bits, by rounds."""
    rng = np.random.default_rng(6)
    many = rng.integers(0, 2**64, 300_000, dtype=np.uint64)
    ball = np.array([sum(1 << b for b in c) for k in range(4) for c in itertools.combinations(range(64), k)], dtype=np.uint64)
    for h, most in ((many, 22), (np.concatenate([rng.permutation(ball), rng.integers(0, 2**64, 40_000, dtype=np.uint64)]), 3)):
        rows = spark.createDataFrame(pa.table({"scope": pa.array(["s"] * len(h)), "rank_key": pa.array(np.arange(len(h))), "hash": pa.array(h.view(np.int64))}))
        got = sorted(r.rank_key for r in dedupe.near_duplicates(rows, most).select("rank_key").collect())
        assert got == greedy_pass.in_order(h, most).tolist()


def test_first_rows_of_a_hot_key(spark):
    rows = spark.range(0, 200_000, 1, 4).selectExpr("if(id % 10 = 0, id % 7, null) as k", "-(id * 7919 % 200003) as v", "id")
    sent = pruned(rows, 5000, ["k"], ["v", "id"]).where("k is null")
    assert sent.count() <= 4 * 5000
    want = rows.orderBy("v", "id").where("k is null").limit(5000).agg(F.sum("id")).first()[0]
    found = first_rows(rows, 5000, ["k"], ["v", "id"])
    assert found.where("k is null").agg(F.sum("id")).first()[0] == want
    assert found.groupBy("k").count().agg(F.max("count"), F.count("count")).first()[:] == (5000, 8)


def test_long_chain_settles(spark):
    pairs = spark.createDataFrame([("s", f"{i:03d}", f"{i + 1:03d}") for i in range(40)], "scope string, a string, b string")
    nodes = spark.createDataFrame([("s", f"{i:03d}") for i in range(41)], "scope string, rank_key string")
    assert {r.rank_key for r in dedupe.greedy_keep(pairs, nodes).collect()} == {f"{i:03d}" for i in range(0, 41, 2)}


def test_chain_of_a_thousand(spark, monkeypatch):
    """In one task, and by rounds until few enough pairs are left."""
    pairs = spark.createDataFrame([("s", i, i + 1) for i in range(1000)] + [("t", i, i + 1) for i in range(20)], "scope string, a long, b long")
    nodes = spark.createDataFrame([("s", i) for i in range(1001)] + [("t", i) for i in range(30)], "scope string, rank_key long")
    want = {("s", i) for i in range(0, 1001, 2)} | {("t", i) for i in range(0, 21, 2)} | {("t", i) for i in range(21, 30)}
    for whole in (dedupe.WHOLE, 990):
        monkeypatch.setattr(dedupe, "WHOLE", whole)
        assert {tuple(r) for r in dedupe.greedy_keep(pairs, nodes).collect()} == want


@pytest.mark.parametrize("most", [9, 22])
def test_many_bits_by_blocks(spark, monkeypatch, most):
    """Pairs and the greedy pass over blocks far smaller than a scope."""
    monkeypatch.setattr(dedupe, "BLOCK", 7)
    rnd = random.Random(most)
    rows = list({h: (f"s{i % 2}", i, h) for i in range(90) for h in [rnd.getrandbits(64) >> rnd.choice([0, 0, 20]) << 5 & 2**64 - 1]}.values())
    df = spark.createDataFrame([(s, k, h - 2**64 if h >= 2**63 else h) for s, k, h in rows], "scope string, rank_key long, hash long")
    got = [tuple(r) for r in dedupe.near_pairs(df, most).collect()]
    assert sorted(got) == sorted((s, a, b) for s, a, h in rows for z, b, g in rows if s == z and a < b and (h ^ g).bit_count() <= most)


@pytest.mark.parametrize("n", [0, 1, 300])
def test_places(spark, n):
    rnd = random.Random(n)
    rows = [(rnd.choice(["a", "a", "a", "b", None]), f"k{rnd.randrange(50):02d}", i) for i in range(n)]
    df = spark.createDataFrame(rows, "g string, k string, i long")
    at = {r.i: r.at for r in places(df, ["k", "i"]).collect()}
    assert [i for i, _ in sorted(at.items(), key=lambda x: x[1])] == [i for *_, i in sorted(rows, key=lambda r: r[1:])] and sorted(at.values()) == list(range(1, n + 1))
    within = {r.i: r.at for r in places(df, ["k", "i"], ("g",)).collect()}
    for g in {r[0] for r in rows}:
        assert [within[i] for *_, i in sorted((r for r in rows if r[0] == g), key=lambda r: r[1:])] == list(range(1, sum(r[0] == g for r in rows) + 1))


def test_selectors(spark):
    html = """<html><body><ul class="list wide"><li class=item><a href="/a?x=1&amp;y=2" title=" T  1 ">One <b>bold</b></a><p class="s">first<p class="s">second</li>
      <li class="item"><a>no link</a></li><li class="item"><a href="b.html">Two</a></li></ul><a id=next href="?page=2">more</a>
      <div class=gallery><img src="/t/1.jpg" data-big="/b/1.jpg" alt="A"><img src="/t/logo.png"><img src="/t/2.jpg" alt=" "></div></body></html>"""
    pages = spark.createDataFrame([(1, "https://h.org/s/", html), (2, "https://h.org/", None), (3, None, "<p>x")], "page_id long, url string, html string")
    found = S_markup.search_results(pages, {"listing_selector": "ul.list > li.item", "link_selector": "a::attr(href)", "title_selector": "a::text", "snippet_selector": "p.s::text, i::text", "next_page_selector": "#next::attr(href)"}).orderBy("pos").collect()
    assert [tuple(r)[2:] for r in found] == [(0, "https://h.org/a?x=1&y=2", "One", "first", "https://h.org/s/?page=2"), (1, "https://h.org/s/b.html", "Two", None, "https://h.org/s/?page=2")]
    got = S_markup.detail_images(pages, {"gallery_selector": ".gallery img[src]", "original_attr": "data-big", "thumbnail_attr": "src", "caption_attrs": ["title", "alt"], "filters": {"allow_substrings": [".jpg", ".png"], "deny_substrings": ["logo"]}}).collect()
    assert [tuple(r)[2:] for r in got] == [(["https://h.org/b/1.jpg", "https://h.org/t/2.jpg"], ["https://h.org/t/1.jpg", "https://h.org/t/2.jpg"], ["A", None])]
    assert S_markup.search_results(pages, {}).count() == 0 and S_markup.detail_images(pages, {}).count() == 0


def test_shared_folder_is_asked_for_on_a_cluster():
    class Session:
        conf = type("", (), {"get": staticmethod(lambda *_: None)})
        sparkContext = type("", (), {"master": "spark://h:7077", "getCheckpointDir": staticmethod(lambda: None)})

    with pytest.raises(RuntimeError, match="checkpoint"):
        shared_folder(Session)


def png(path, grey):
    h, w = grey.shape
    raw = b"".join(b"\0" + grey[y].tobytes() for y in range(h))
    chunk = lambda kind, data: struct.pack(">I", len(data)) + kind + data + struct.pack(">I", zlib.crc32(kind + data))
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_bytes(b"\x89PNG\r\n\x1a\n" + chunk(b"IHDR", struct.pack(">IIBBBBB", w, h, 8, 0, 0, 0, 0)) + chunk(b"IDAT", zlib.compress(raw)) + chunk(b"IEND", b""))


def test_pictures(spark, tmp_path):
    rng = np.random.default_rng(0)
    noise = rng.integers(0, 256, (240, 230), dtype=np.uint8)
    png(tmp_path / "a/sharp.png", noise)
    png(tmp_path / "b/copy.png", noise)
    png(tmp_path / "a/flat.png", np.full((240, 240), 90, np.uint8))
    png(tmp_path / "a/small.png", noise[:50, :50])
    png(tmp_path / ".trash/blur_1/a/old.png", noise)
    (tmp_path / "a/broken.png").write_bytes(b"no picture")
    (tmp_path / "a/notes.txt").write_text("x")
    listed = S.list_images(S.list_files(spark, str(tmp_path), [".trash"]))
    assert listed.count() == 6
    rows = dedupe.image_features(S.read_images(spark, str(tmp_path))).where("path not like '%.txt'").withColumn("root", F.lit("r"))
    early = rows.withColumn("action", dedupe.quality_action()).withColumn("hash", F.col("perceptual_hash"))
    late = dedupe.exact_duplicates(early.where("action is null"))
    got = {r.path.rsplit("/", 2)[-2] + "/" + r.path.rsplit("/", 1)[-1]: r.action for r in early.where("action is not null").collect()}
    assert got == {"a/flat.png": "blur", "a/small.png": "small", "a/broken.png": "error"}
    assert {r.path.rsplit("/", 2)[-2]: r.duplicate for r in late.collect()} == {"a": False, "b": True}
    f = {r.path.rsplit("/", 1)[-1]: r for r in rows.collect()}
    g = noise.astype(float)
    lap = g[:-2, 1:-1] + g[2:, 1:-1] + g[1:-1, :-2] + g[1:-1, 2:] - 4 * g[1:-1, 1:-1]
    assert f["sharp.png"].laplacian == pytest.approx(lap.var()) and f["flat.png"].tenengrad == 0


def test_kernels_agree(spark):
    rng = np.random.default_rng(1)
    g = rng.random((8, 8))
    df = spark.createDataFrame([(g.ravel().tolist(),)], "px array<double>").select(I.laplacian_variance(F.col("px"), 8, 8), I.tenengrad(F.col("px"), 8, 8), I.average_hash(F.col("px")), I.median_hash(F.col("px"))).first()
    lap, ten = I.sharpness(g)
    assert df[0] == pytest.approx(lap) and df[1] == pytest.approx(ten)
    assert df[2] == I._pack(g >= g.mean()) and df[3] == I._pack(g >= np.median(g))
    assert I.resized(np.arange(64.0).reshape(8, 8), 8).tolist() == np.arange(64.0).reshape(8, 8).tolist()
    assert I.perceptual_hash(rng.random((40, 50))).bit_count() >= 32


def test_merge_choices(spark):
    classes = spark.createDataFrame([(x,) for x in ("Tomatoes plant", "Açaí plant", "Olives", "Beans", "moths", "Maize (Corn) plant", "a/b")], "source_class string")
    existing = spark.createDataFrame([("tomato", "tomato"), ("moth", "Moth"), ("beans", "Beans")], "key string, folder string")
    got = {r.source_class: (r.dest, r.existed) for r in merge.choose_folder(classes, existing, merge.alias_table(spark)).collect()}
    assert got == {"Tomatoes plant": ("tomato", True), "Açaí plant": ("Acai", False), "Olives": ("Olive-tree", False), "Beans": ("Beans", True), "moths": ("Moth", True), "Maize (Corn) plant": ("maize", False), "a/b": ("a-b", False)}


def test_caps_are_monotonic(spark):
    rows = spark.createDataFrame([("k", i, list("x" * n)) for i, n in enumerate([2, 2, 3])], "k string, i int, images array<string>")
    assert [len(r.images) for r in ingest.cap_images(rows, 5, ["k"], ["i"]).orderBy("i").collect()] == [2, 2, 1]
    total = [ingest.cap_images(rows, c, ["k"], ["i"]).agg(F.sum(F.size("images"))).first()[0] or 0 for c in range(9)]
    assert total == [min(c, 7) for c in range(9)]


def test_verdicts(spark):
    good = '{"is_match": true, "actual_class": null, "quality_score": 1, "rejection_reason": null, "description_en": "a", "description_zh": "b"}'
    cases = {good: None, good.replace("1,", "true,"): None, good.replace("true", '"yes"'): "type:is_match", good.replace('"a"', "null"): "type:description_en", "x": "bad_json", "3": "bad_json", "{}": "missing:is_match"}
    df = spark.createDataFrame([(k,) for k in cases], "t string").select("t", verify.verdict_error(F.col("t")).alias("e"))
    assert {r.t: r.e for r in df.collect()} == cases


def test_readers(spark, tmp_path):
    (tmp_path / "m.json").write_text('{"a": "b"}')
    (tmp_path / "bad.json").write_text("{")
    assert [tuple(r) for r in S.read_json_map(spark, f"{tmp_path}/m.json").collect()] == [("a", "b")]
    assert S.read_json_map(spark, f"{tmp_path}/bad.json").count() == 0 and S.read_json_map(spark, f"{tmp_path}/none.json").count() == 0
    with pytest.raises(Exception):  # noqa: B017
        S.read_json_map(spark, f"{tmp_path}/none.json", required=True).count()
    (tmp_path / "t.csv").write_text("image_id,rust\nx,1\n")
    assert S.read_table(spark, f"{tmp_path}/t.csv").dtypes == [("image_id", "string"), ("rust", "string")]
    text = spark.createDataFrame([("no list",), ("const m = [];",)], "value string")
    assert S.review_entries(text, wrapped=True).count() == 0


def test_manifest_of_trash(spark):
    paths = {"r/.trash/x.jpg": ("__trash__", ".trash", None), "r/.trash/s/x.jpg": ("__trash__", "s", None), "r/.trash/k/s/x.jpg": ("k", "s", None), "r/.trash/blur_1/k/s/x.jpg": ("k", "s", "blur_1"), "r/.trash/a/k/k/s/x.jpg": ("k", "s", "a/k"), "r/x.jpg": ("x.jpg", "", None), "r/k/s/x.jpg": ("k", "s", None)}
    got = {r.path: (r.keyword, r.source, r.trash_reason) for r in review.manifest(spark.createDataFrame([(p,) for p in paths], "path string"), "r").collect()}
    assert got == paths | {"r/x.jpg": ("x.jpg", "r", None)}


def test_plan_is_carried_out(spark, tmp_path):
    (tmp_path / "a").write_text("x")
    plan = spark.createDataFrame([("move", f"{tmp_path}/a", f"{tmp_path}/b"), ("move", f"{tmp_path}/none", f"{tmp_path}/c")], "op string, src string, dst string")

    def act(op, src, dst):
        import os

        os.rename(src, dst)

    errors = [r.error for r in K.perform(plan, act).orderBy("src").collect()]
    assert errors[0] is None and "none" in errors[1] and (tmp_path / "b").exists()
