from collections import Counter, defaultdict

import pytest

import corpus_pipeline
from __spark_entry__ import queries
from quotaloom.llm.common import documents, stored

SF = "/root/testdata/sf0.001"
COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


@pytest.fixture(scope="module")
def kept(spark):
    docs, out = documents(spark, SF), []
    for name, stage in corpus_pipeline.STAGES:
        docs = stored(stage(spark, docs, SF), f"test-{name}")
        out.append(docs)
    return out


def test_stages_hand_on_documents(kept):
    assert [name for name, _ in corpus_pipeline.STAGES] == ["toxicity", "exact_dedup", "simhash_dedup", "source_mixing", "packing"]
    assert all(df.columns == COLUMNS for df in kept[:-1])


def test_toxic_documents_go_and_clean_ones_stay(spark, kept):
    labels = {r.doc_id: r.toxic for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    left = {r.doc_id for r in kept[0].collect()}
    clean = [i for i, t in labels.items() if not t]
    assert sum(i in left for i in clean) >= 0.95 * len(clean)
    assert len(left) < 200


def test_copies_go(kept):
    before, exact, near = (df.collect() for df in kept[:3])
    content = lambda r: "".join(r.text.split())
    assert {content(r) for r in before} == {content(r) for r in exact} and len(exact) == len({content(r) for r in exact})
    assert {r.doc_id for r in near} <= {r.doc_id for r in exact}


def test_mix_repeats_and_packing_takes_all(kept):
    near, mixed, packed = (df.collect() for df in kept[2:])
    times = Counter(r.doc_id for r in mixed)
    assert max(times.values()) <= 3 and set(times) <= {r.doc_id for r in near}
    assert Counter(r.doc_id for r in packed if r.piece == 0) == times
    room = defaultdict(int)
    for r in packed:
        room[r.sequence_id] += r.length
    assert max(room.values()) <= 4096


def test_run_equals_its_stages(spark, kept):
    got = queries()["pipeline"](spark, SF)
    assert got.count() == kept[-1].count()
