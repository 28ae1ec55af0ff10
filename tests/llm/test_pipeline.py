"""The pipeline on a small folder: each stage against a plain version on its own input."""

import random
import zlib

import numpy as np
from tokenizers import Tokenizer

import corpus_pipeline
from addrweave.llm.toxicity import toxicity
from addrweave.llm.tokens import vocabulary
from tests.llm.test_decontamination import brute as leaks
from tests.llm.test_near_duplicates import brute as groups
from tests.llm.test_packing import check

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def test_stages_and_run(spark, tmp_path):
    rng = random.Random(9)
    word = lambda: "".join(rng.choice(["an", "er", "th", "in", "ou", "le"]) for _ in range(rng.randint(1, 4)))
    items = [(i, " ".join(word() for _ in range(20))) for i in range(5)]
    rows, labels = [], []
    for d in range(160):
        w = [word() for _ in range(60)]
        if d % 10 == 0:
            w[::6] = [rng.choice(["vile", "scum", "moron"]) + word() for _ in range(10)]
        if d % 10 == 1:
            w[5:5] = items[d % 5][1].split()
        if d % 10 == 2:
            w.insert(7, f"password=abc{d}def")
        text = " ".join(w) if d % 10 != 3 else rows[-1][1] + " more"
        rows.append((d, text))
        labels.append((d, int(d % 10 == 0)))
    rows += [(1000, None), (1001, "")]
    spark.createDataFrame([(d, t, "en", None, len(t or "")) for d, t in rows], SCHEMA).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    docs, sf = spark.read.parquet(f"{tmp_path}/documents.parquet"), str(tmp_path)
    rows_of = lambda df: {(r.doc_id, r.text) for r in df.collect()}
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        before, after = rows_of(docs), stage(spark, docs, sf)
        if name == "packing":
            break
        assert after.columns == docs.columns
        after.write.parquet(f"{tmp_path}/{k}")
        after = spark.read.parquet(f"{tmp_path}/{k}")
        if name == "toxicity":
            bad = {r.doc_id for r in toxicity(docs, spark.read.parquet(f"{sf}/labels.parquet")).collect() if r.predicted}
            assert bad >= {d for d, t in labels if t} and rows_of(after) == {r for r in before if r[0] not in bad}
        elif name == "near_duplicates":
            kept = groups(sorted(before))
            assert rows_of(after) == {r for r in before if kept[r[0]][2]} and len(rows_of(after)) < len(before)
        elif name == "decontamination":
            bad = {d for d, _ in leaks(sorted(before), items)}
            assert bad and rows_of(after) == {r for r in before if r[0] not in bad}
        else:
            assert {d for d, _ in rows_of(after)} == {d for d, _ in before} and all("password=" not in (t or "") for _, t in rows_of(after))
        docs = after
    library = Tokenizer.from_file(vocabulary())
    ids = {d: np.asarray([*library.encode(t or "", add_special_tokens=False).ids, 0], "<u4") for d, t in before}
    for got in (after.collect(), corpus_pipeline.run(spark, sf).collect()):
        assert {(r.doc_id, r.length, r.ids_crc32) for r in got} == {(d, len(x), zlib.crc32(x.tobytes())) for d, x in ids.items()}
        check(got, 2048)
