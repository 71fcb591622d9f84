"""The pipeline stage by stage against plain rules, on the smallest tables and on no rows at all."""

import collections
import hashlib

import corpus_pipeline
import pandas as pd
import pytest

from casemill.llm.queries import vocabulary

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def stages(spark, tmp_path_factory):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    found = [("input", docs.toPandas())]
    for name, step in corpus_pipeline.STAGES:
        path = str(tmp_path_factory.mktemp("stage") / name)
        step(spark, docs, SF).write.parquet(path)
        docs = spark.read.parquet(path)
        found.append((name, docs.toPandas()))
    return found


def test_stages(stages):
    import tiktoken

    rows = dict(stages)
    assert [n for n, _ in stages] == ["input", "toxicity", "exact_dedup", "near_dedup", "mix_sources", "byte_bpe"]
    whole = rows["input"].set_index("doc_id")
    for name in ("toxicity", "exact_dedup", "near_dedup", "mix_sources"):
        assert list(rows[name].columns) == list(rows["input"].columns)
        pd.testing.assert_frame_equal(rows[name].set_index("doc_id"), whole.loc[rows[name].doc_id])
    clean, single, apart, mixed = (rows[n] for n in ("toxicity", "exact_dedup", "near_dedup", "mix_sources"))
    labels = pd.read_parquet(f"{SF}/labels.parquet").set_index("doc_id").toxic
    assert labels.reindex(clean.doc_id).eq(0).sum() >= 0.97 * labels.eq(0).sum()
    assert sorted(single.doc_id) == sorted(clean.groupby("text").doc_id.max())

    def shingles(text):
        words = text.lower().split()
        return {tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))}

    sets = {i: shingles(t) for i, t in zip(single.doc_id, single.text)}
    gone = set(single.doc_id) - set(apart.doc_id)
    links = collections.defaultdict(set)
    for a in sets:
        for b in sets:
            if a < b and 100 * len(sets[a] & sets[b]) >= 85 * len(sets[a] | sets[b]):
                links[a].add(b)
                links[b].add(a)
    assert all(not links[a] & set(apart.doc_id) for a in apart.doc_id)
    assert all(links[a] for a in gone)
    copies = mixed.doc_id.value_counts()
    assert copies.max() <= 2 and set(copies.index) <= set(apart.doc_id)

    ranks, pattern = vocabulary()
    judge = tiktoken.Encoding("own", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
    want = sorted((i, len(judge.encode_ordinary(t))) for i, t in zip(mixed.doc_id, mixed.text))
    assert sorted(zip(rows["byte_bpe"].doc_id, rows["byte_bpe"].n_tokens)) == want


def test_ids_are_decoded(spark):
    texts = {1: "plain words", 2: "é𝄞 \n 漢", 3: ""}
    docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    got = {r.doc_id: r.decoded_sha256 for r in corpus_pipeline.encode(spark, docs, SF).collect()}
    assert got == {i: hashlib.sha256(t.encode()).hexdigest() for i, t in texts.items()}


def test_run_and_no_rows(spark, stages):
    got = corpus_pipeline.run(spark, SF).toPandas()
    pd.testing.assert_series_equal(got.doc_id.sort_values().reset_index(drop=True), stages[-1][1].doc_id.sort_values().reset_index(drop=True))
    docs = spark.read.parquet(f"{SF}/documents.parquet").limit(0)
    for _, step in corpus_pipeline.STAGES:
        docs = step(spark, docs, SF)
    assert docs.count() == 0
