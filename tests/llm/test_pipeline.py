import random
import re

import test_line_dedup
import test_packing
import test_simhash
from pyspark.sql import functions as F

import corpus_pipeline
from millrace.llm.line_dedup import MIN_CHARS
from millrace.llm.secrets import MASK, scan_documents, train
from millrace.llm.toxicity import score, train_on_labels

HEX = "24be64439e3e49cf46b2d7c90f3602a3d0b907ff"


def write(spark, folder):
    rnd = random.Random(8)
    vocab = ["".join(rnd.choice("abcdeioé") for _ in range(rnd.randint(2, 8))) for _ in range(300)]
    lines = [" ".join(rnd.choice(vocab) for _ in range(rnd.randint(1, 30))) for _ in range(30)]
    docs, labels = [], []
    for i in range(260):
        own = ["".join(x) for x in ([rnd.choice(lines)] if rnd.random() < 0.4 else [])] + [" ".join(rnd.choice(vocab) for _ in range(rnd.randint(1, 60))) for _ in range(rnd.randint(1, 3))]
        toxic = i % 5 == 0
        if toxic:
            own.append(" ".join(["vile", rnd.choice(vocab), "rotten", rnd.choice(vocab), "wicked"]))
        if i % 17 == 1:
            own.append(f'token = "{HEX[i % 9:]}{i:03d}00000000"')
        text = "\n".join(own) if i % 40 != 3 or not docs else docs[-3][1]
        docs.append((i, text, "en", f"s{i % 3}", len(text)))
        if text == "\n".join(own):
            labels.append((i, 1, int(toxic)))
    docs += [(300, None, None, None, None), (301, "", "en", "s0", 0), (302, "x " * 4000, "en", "s0", 8000)]
    spark.createDataFrame(docs, "doc_id long, text string, lang string, source string, n_chars long").repartition(3).write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
    return docs, dict((d, t) for d, _, t in labels)


def test_stages_against_brute_force(spark, tmp_path):
    docs, toxic = write(spark, tmp_path)
    at = spark.read.parquet(f"{tmp_path}/documents.parquet")
    columns, texts, outs = at.columns, {d: t for d, t, *_ in docs}, []
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, at, str(tmp_path)).write.parquet(f"{tmp_path}/out{k}")
        before, at = at, spark.read.parquet(f"{tmp_path}/out{k}")
        outs.append(name)
        if name == "toxicity":
            model = train_on_labels(before, spark.read.parquet(f"{tmp_path}/labels.parquet"))
            want = {r.doc_id for r in score(before, model).where("score < 0.3").collect()}
            texts = {d: t for d, t in texts.items() if d in want}
            right = [(d in texts) == (t == 0) for d, t in toxic.items()]
            assert sum(right) > 0.97 * len(right)
        elif name == "line_dedup":
            texts = {d: t for d, (_, _, t) in test_line_dedup.brute(list(texts.items()), MIN_CHARS).items()}
        elif name == "simhash_near_dedup":
            prints = {d: test_simhash.fingerprint(t) for d, t in texts.items()}
            group, first = test_simhash.groups(set(prints.values())), {}
            for d in sorted(texts):
                first.setdefault(group[prints[d]], d)
            texts = {d: texts[d] for d in first.values()}
        elif name == "secret_scans":
            found = {}
            for r in scan_documents(before, train()).where(F.col("is_secret")).collect():
                found.setdefault(r.doc_id, []).append((r.start, r.length))
            assert found
            for d, spans in found.items():
                for start, n in sorted(spans, reverse=True):
                    texts[d] = texts[d][:start] + MASK + texts[d][start + n :]
            assert not any(re.search(HEX[9:], t or "") for t in texts.values())
        if name != "best_fit_packing":
            assert at.columns == columns and at.dtypes == before.dtypes
            rows = at.collect()
            assert len(rows) == len(texts) and {r.doc_id: r.text for r in rows} == texts
            assert all(r.n_chars == len(r.text or "") for r in rows if name != "toxicity" and r.doc_id != 300)
    assert outs == ["toxicity", "line_dedup", "simhash_near_dedup", "secret_scans", "best_fit_packing"]
    test_packing.check(at.collect(), list(texts.items()), 2048)
    whole = corpus_pipeline.run(spark, str(tmp_path))
    assert {(r.doc_id, r.piece, r.ids_crc32) for r in whole.collect()} == {(r.doc_id, r.piece, r.ids_crc32) for r in at.collect()}
