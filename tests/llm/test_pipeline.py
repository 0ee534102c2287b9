import collections

import corpus_pipeline as cp
import pytest

from playlens.llm.mixing import mix_plan
from tests.llm.helpers import SF, clashing, components, lower, rows_of
from tests.llm.test_packing import check_pack
from tests.llm.test_simhash import brute_fingerprint

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]
STRIP = " \t\n\x0b\x0c\r"


def brute_lines(texts):
    """Texts by id without lines of 20 characters that three documents share, but in the largest id."""
    holders = collections.defaultdict(set)
    for i, text in texts.items():
        for line in text.split("\n"):
            if len(key := lower(line.strip(STRIP))) >= 20:
                holders[key].add(i)
    keep = {k: max(v) for k, v in holders.items() if len(v) >= 3}
    return {i: "\n".join(x for x in t.split("\n") if keep.get(lower(x.strip(STRIP)), i) == i) for i, t in texts.items()}


@pytest.fixture(scope="module")
def stages(spark, tmp_path_factory):
    folder = tmp_path_factory.mktemp("stages")
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    out = {"documents": docs}
    for name, stage in cp.STAGES:
        stage(spark, docs, SF).write.parquet(f"{folder}/{name}")
        docs = out[name] = spark.read.parquet(f"{folder}/{name}")
    return out


def texts(df):
    return {r["doc_id"]: r["text"] for r in df.collect()}


def test_names_and_columns(stages):
    assert len(cp.STAGES) == 5 and cp.ORACLE_SQL is None
    for name in ("quality_classifier", "line_dedup", "simhash_near_dedup", "temperature_mixing"):
        assert stages[name].columns == COLUMNS


def test_classifier_keeps_clean_documents_whole(spark, stages):
    kept, every = texts(stages["quality_classifier"]), texts(stages["documents"])
    assert all(every[i] == t for i, t in kept.items())
    labels = {r["doc_id"]: r["quality"] for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    clean = [i for i, y in labels.items() if y == 1]
    junk = [i for i, y in labels.items() if y == 0]
    assert sum(i in kept for i in clean) >= 0.97 * len(clean) and sum(i in kept for i in junk) <= 0.2 * len(junk)


def test_lines(stages):
    want = brute_lines(texts(stages["quality_classifier"]))
    assert texts(stages["line_dedup"]) == want
    assert all(r["n_chars"] == len(want[r["doc_id"]]) for r in stages["line_dedup"].collect())


def test_one_document_of_each_group_stays(stages):
    before = texts(stages["line_dedup"])
    ids = sorted(before)
    fps = [brute_fingerprint(before[i]) for i in ids]
    root = components(len(ids), lambda i, j: (fps[i] ^ fps[j]).bit_count() <= 2)
    assert texts(stages["simhash_near_dedup"]) == {ids[r]: before[ids[r]] for r in set(root)}


def test_mixing_uses_every_document(spark, stages):
    before, after = stages["simhash_near_dedup"], stages["temperature_mixing"]
    uses = collections.Counter(r["id"] for r in mix_plan(before, max_repeats=cp.MAX_REPEATS).collect())
    assert collections.Counter(r["doc_id"] for r in after.collect()) == uses
    assert texts(after) == texts(before) and max(uses.values()) <= 3


def test_packing(stages):
    rows = [(r["doc_id"], r["text"], r["source"]) for r in stages["temperature_mixing"].collect()]
    check_pack(stages["best_fit_packing"].collect(), rows, cp.CAPACITY)


def test_run(spark, stages):
    cols = ["doc_id", "copy", "piece", "bin_id", "bin_offset"]
    assert rows_of(cp.run(spark, SF), *cols) == rows_of(stages["best_fit_packing"], *cols)


def test_odd_rows_and_empty_tables(spark):
    rows = [(None, None, None, None, None), (1, "", "en", None, 0), (1, "", "en", None, 0), (2, "word " * 20_000, None, "s", None)]
    rows += [(i, f"clean words of a short text number {i}", "en", "s0", 3) for i in range(3, 9)]
    odd = clashing(spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long"), "score", "fp", "copy", "_doc")
    for start in (odd, odd.where("doc_id < 0")):
        docs, ids = start, {}
        for name, stage in cp.STAGES:
            docs = stage(spark, docs, SF).cache()
            ids[name] = {r["doc_id"] for r in docs.select("doc_id").collect()}
            assert name == "best_fit_packing" or docs.columns == odd.columns
        # Line dedup keeps every document, mixing and packing too; near copies leave one of a group.
        assert ids["line_dedup"] == ids["quality_classifier"] <= {r["doc_id"] for r in start.select("doc_id").collect()}
        assert ids["simhash_near_dedup"] <= ids["line_dedup"]
        assert ids["best_fit_packing"] == ids["temperature_mixing"] == ids["simhash_near_dedup"]
        assert bool(ids["best_fit_packing"]) == (start is odd)
