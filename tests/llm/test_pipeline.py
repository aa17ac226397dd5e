"""The pipeline of five stages: plain recomputation of each stage's decision, and awkward rows through all of them."""

import random

import pytest
from test_models_and_pages import pattern_spans
from test_pairs_and_texts import brute_leaks, jaccard_components

import corpus_pipeline as pipeline

SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint, secrets string, toxicity double, rate string, `_h` int, component string"


def row(i, text):
    return (i, text, "en", "src0", None if text is None else len(text), "kept", 0.5, "r", 7, "c")


def write(spark, folder, docs, labels=(), benchmark=()):
    for name, rows, schema in (("documents", docs, SCHEMA), ("labels", labels, "doc_id bigint, quality int, toxic int"), ("benchmark", benchmark, "item_id bigint, text string")):
        spark.createDataFrame(list(rows), schema).coalesce(2).write.mode("overwrite").parquet(f"{folder}/{name}.parquet")


def stages(spark, folder):
    """Input and output of each stage, as the pipeline runs them."""
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    for name, stage in pipeline.STAGES:
        out = stage(spark, docs, str(folder))
        out.write.mode("overwrite").parquet(f"{folder}/out-{name}")
        after = spark.read.parquet(f"{folder}/out-{name}")
        yield name, docs, after
        docs = after


@pytest.fixture(scope="module")
def corpus():
    rng = random.Random(21)
    vocabulary = [f"w{i}" for i in range(900)]
    items = [(i, " ".join(rng.choice(vocabulary) for _ in range(30))) for i in range(6)]
    docs, labels = [], []
    for i in range(400):
        words = [rng.choice(vocabulary) for _ in range(rng.randint(20, 60))]
        toxic = i % 5 == 0
        if toxic:
            words += ["dreadful", "martians"]
        elif i % 17 == 0:
            words += items[i % 6][1].split()
        elif i % 7 == 0:
            words += ["token", "=", "".join(rng.choice("abcdefXYZ0123456789") for _ in range(24))]
        elif i % 11 == 0 and docs[-1][1]:
            words = docs[-1][1].split()[:-1]
        docs.append(row(i, " ".join(words)))
        if rng.random() < 0.7:
            labels.append((i, int(rng.random() < 0.7), int(toxic)))
    return docs, labels, items


def test_each_stage_decides_as_recomputed(spark, tmp_path, corpus):
    docs, labels, items = corpus
    write(spark, tmp_path, docs, labels, items)
    for name, before, after in stages(spark, tmp_path):
        was, now = ({r.doc_id: r for r in df.collect()} for df in (before, after))
        texts = [(i, r.text) for i, r in was.items()]
        gone = was.keys() - now.keys()
        assert after.columns[: len(before.columns)] == before.columns or name == "mixing"
        assert set(before.columns) <= set(after.columns)
        if name == "toxicity":
            toxic = {i for i, t in texts if "martians" in t}
            assert len(gone & toxic) >= 0.95 * len(toxic) and len(gone - toxic) <= 0.03 * len(texts)
        elif name == "near_duplicates":
            assert gone == {i for i, (_, c) in jaccard_components(texts, 5, 80).items() if c != i} and gone
        elif name == "decontamination":
            assert gone == {i for i, _ in brute_leaks(texts, items)} and gone
        elif name == "secrets":
            assert not gone
            for i, r in now.items():
                assert r.n_chars == len(r.text) and not pattern_spans(r.text)
                if not pattern_spans(was[i].text):
                    assert r.text == was[i].text
        else:
            assert not gone and all(int(r.copies) >= 0 for r in now.values())
    final = {r.doc_id for r in pipeline.run(spark, str(tmp_path)).select("doc_id").collect()}
    assert final == set(now)


def test_awkward_rows_go_through_all_stages(spark, tmp_path):
    long = " ".join(f"v{i}" for i in range(40_000))
    docs = [row(None, "no id here"), row(None, None), row(1, None), (2, "", None, None, None, None, None, None, None, None), row(3, long), row(3, long), row(4, long), row(5, "twice"), row(5, "twice"), row(6, "twice")]
    write(spark, tmp_path, docs, [(None, None, None), (3, None, None), (3, 1, 0), (99, 0, 1)], [(None, "x"), (1, None), (2, "")])
    for name, before, after in stages(spark, tmp_path):
        assert before.columns == after.columns[: len(before.columns)] or name == "mixing"
    got = sorted((str(r.doc_id), r.text is None, r.secrets) for r in after.collect())
    assert got == sorted([("None", False, "kept"), ("None", True, "kept"), ("1", True, "kept"), ("2", False, None), ("3", False, "kept"), ("3", False, "kept"), ("5", False, "kept"), ("5", False, "kept")])
    assert {"n_tokens", "rate", "copies"} <= set(after.columns)


def test_empty_tables_give_an_empty_result(spark, tmp_path):
    write(spark, tmp_path, [])
    assert [after.count() for _, _, after in stages(spark, tmp_path)] == [0] * 5
    assert pipeline.run(spark, str(tmp_path)).count() == 0


def test_stages_stand_in_their_order():
    assert [n for n, _ in pipeline.STAGES] == ["toxicity", "near_duplicates", "decontamination", "secrets", "mixing"]
    assert pipeline.ORACLE_SQL is None
