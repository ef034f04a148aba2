"""Every stage of the pipeline against brute force, on its own input."""

import random
from collections import Counter, defaultdict

import corpus_pipeline
from helpers import awkward, documents, shingles, words
from pyspark.sql import functions as F
from test_lines_urls import brute_lines
from test_mixing_packing import _spans_of, brute_targets
from test_search_archives_toxicity import labelled

from barforge.llm import op3_toxicity


def corpus(spark, path):
    texts, labels = labelled(random.Random(9), 300)
    rows = [(d, t, f"s{d % 3}") for d, t, _ in texts]
    rows += [(None if d is None else d + 10_000, t, "s1") for d, t in awkward(random.Random(9)) if d != 15]
    shared = "\n".join(["a line that several documents hold", "and another one of them"])
    rows += [(20_000 + i, f"{shared}\nown words {i} of this one", "s2") for i in range(8)]
    documents(spark, rows).select("doc_id", "text", "lang", "source", "n_chars").write.parquet(f"{path}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{path}/labels.parquet")
    return spark.read.parquet(f"{path}/documents.parquet")


def order(rows):
    return sorted(rows, key=repr)


def near_groups(rows):
    """Rows by component of near duplicates; a row without words is a group of its own."""
    sets, groups = [shingles(t) for _, t in rows], []
    for row, own in zip(rows, sets):
        near = [g for g in groups if own and any(x and 100 * len(own & x) >= 75 * len(own | x) for _, x in g)]
        groups = [g for g in groups if g not in near] + [[(row, own), *(m for g in near for m in g)]]
    return [[r for r, _ in g] for g in groups]


def test_stages(spark, tmp_path):
    sf = str(tmp_path)
    docs = corpus(spark, sf)
    assert [n for n, _ in corpus_pipeline.STAGES] == ["toxicity", "line dedup", "near dedup", "mixing", "packing"]
    kept = {}
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, sf)
        out.write.parquet(f"{sf}/out/{name}")
        out = spark.read.parquet(f"{sf}/out/{name}")
        if name != "packing":
            assert out.dtypes == docs.dtypes
        kept[name] = docs.collect(), out.collect()
        docs = out

    before, after = kept["toxicity"]
    labels = spark.read.parquet(f"{sf}/labels.parquet")
    source = spark.read.parquet(f"{sf}/documents.parquet")
    scores = op3_toxicity.score_documents(source, op3_toxicity.train(source, labels)).collect()
    assert order(r.doc_id for r in after) == order(r.doc_id for r in scores if r.score < 0.7)
    truth = {r.doc_id: r.toxic for r in labels.collect()}
    left = [truth[r.doc_id] for r in after if r.doc_id in truth]
    assert left.count(0) >= 0.97 * list(truth.values()).count(0) and left.count(1) <= 0.1 * list(truth.values()).count(1)

    before, after = kept["line dedup"]
    want = [(d, t) for d, _, _, t in brute_lines([(r.doc_id, r.text) for r in before])]
    assert order((r.doc_id, r.text) for r in after) == order(want) and any(r.text != s.text for r, s in zip(before, after))

    before, after = kept["near dedup"]
    rows = [(r.doc_id, r.text) for r in before]
    left, groups = Counter((r.doc_id, r.text) for r in after), near_groups(rows)
    assert len(after) == len(groups) < len(before)
    for group in groups:  # exactly one row of each, with the group's smallest id (null ids last)
        least = min(group, key=lambda r: (r[0] is None, r[0] or 0))[0]
        kept_of = [r for r in set(group) if left[r]]
        assert kept_of and all(r[0] == least for r in kept_of)

    before, after = kept["mixing"]
    size, own = defaultdict(int), defaultdict(list)
    for r in before:
        size[r.source] += len(words(r.text))
        own[r.doc_id].append(words(r.text))
    took = defaultdict(int)
    for r in after:
        took[r.source] += len(words(r.text))
        assert any(_spans_of(words(r.text), w) for w in own[r.doc_id])
    assert all(abs(took[s] - t) <= 0.5 for s, t in brute_targets(size).items())

    before, after = kept["packing"]
    assert sum(r.n_words for r in after) == sum(len(words(r.text)) for r in before)
    source, bins = {r.doc_id: r.source for r in before}, defaultdict(list)
    for r in after:
        bins[r.group_id, r.bin].append(r)
    for held in bins.values():
        assert sum(r.n_words for r in held) <= 1024
        assert len({source[r.doc_id] for r in held}) == len(held) == len({r.doc_id for r in held})


def test_run_returns_the_last_stage(spark, tmp_path):
    corpus(spark, str(tmp_path))
    out = corpus_pipeline.run(spark, str(tmp_path))
    assert out.columns[:2] == ["doc_id", "piece"] and out.count() > 50
    assert out.where(F.col("n_words") < 1).isEmpty()
