import collections

import pytest
from cases import empty, odd
from plain import linked
from test_line_dedup import plain as plain_lines

import corpus_pipeline as cp
from eventmill.llm import common, decontamination, packing, toxicity
from eventmill.session import prepare, written

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def kept(spark):
    """What each stage keeps, as {doc_id: text}; the last one's rows."""
    prepare(spark)
    docs, out = common.documents(spark, SF_DIR), []
    out.append({r["doc_id"]: r["text"] for r in docs.collect()})
    for _, stage in cp.STAGES[:-1]:
        docs = written(stage(spark, docs, SF_DIR), "test-stage")
        out.append({r["doc_id"]: r["text"] for r in docs.collect()})
    out.append(cp.STAGES[-1][1](spark, docs, SF_DIR).collect())
    return out


def test_names():
    assert [name for name, _ in cp.STAGES] == [
        "toxicity", "line_dedup", "ngram_jaccard", "decontamination", "packing",
    ]


def test_toxicity_stage(spark, kept):
    docs = common.documents(spark, SF_DIR)
    model = toxicity.train(docs, common.table(spark, SF_DIR, "labels"))
    matcher = toxicity.Matcher(model.learned)
    want = {
        i for i, t in kept[0].items() if model.score(matcher.counts(t)[None, :])[0] < toxicity.REJECT
    }
    assert set(kept[1]) == want and len(want) < len(kept[0])


def test_line_stage(kept):
    want = {i: text for i, _, _, text in plain_lines(list(kept[1].items()))}
    assert kept[2] == want


def test_near_duplicate_stage(kept):
    assert set(kept[3]) == set(linked(sorted(kept[2].items())).values())
    assert all(kept[3][i] == kept[2][i] for i in kept[3])


def test_decontamination_stage(spark, kept):
    items = [r["text"] for r in common.table(spark, SF_DIR, "benchmark").collect()]
    whole = {i for i, t in kept[3].items() if any(x in t for x in items)}
    gone = set(kept[3]) - set(kept[4])
    index = decontamination.build_index(list(enumerate(items)))
    assert whole <= gone
    assert gone == {i for i, t in kept[3].items() if decontamination.find_items(t, index)}


def test_packing_stage(kept):
    ids = packing.WordIds(packing.vocabulary_path())
    want = collections.Counter()
    for i, t in kept[4].items():
        want.update((i, *p) for p in packing.cut(t, ids, packing.CAPACITY))
    got = collections.Counter(
        (r["doc_id"], r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in kept[5]
    )
    assert got == want


def test_run_gives_the_last_stage(spark, kept):
    rows = cp.run(spark, SF_DIR).collect()
    key = ("doc_id", "piece", "start", "length", "ids_crc32")
    assert sorted(tuple(r[k] for k in key) for r in rows) == sorted(
        tuple(r[k] for k in key) for r in kept[5]
    )


@pytest.mark.parametrize("make, ids", [(odd, {None, 1, 2, 4, 5, 6, 8, 9}), (empty, set())])
def test_odd_and_empty_tables(spark, make, ids):
    docs = make(spark)
    columns = docs.columns
    for _, stage in cp.STAGES[:-1]:
        docs = written(stage(spark, docs, SF_DIR), "test-stage")
        assert docs.columns == columns
    packed = cp.STAGES[-1][1](spark, docs, SF_DIR)
    assert {r["doc_id"] for r in packed.collect()} == ids
