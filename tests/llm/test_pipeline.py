from collections import Counter, defaultdict

import pytest
from tests.conftest import MEDIUM
from tests.llm.brute import documents, similar, without_windows, words
from tests.llm.test_mixing import targets
from tokenizers import Tokenizer

import corpus_pipeline as pipeline
from risklake.llm.bpe import vocabulary_path

LABEL = "doc_id long, quality int, toxic int"


@pytest.fixture(scope="module")
def steps(spark):
    """The rows after each stage over the given tables, each the next one's input."""
    docs = spark.read.parquet(f"{MEDIUM}/documents.parquet")
    out = [docs]
    for name, stage in pipeline.STAGES:
        out.append(pipeline.kept(stage(spark, out[-1], MEDIUM), f"test-{name}"))
    return [df.collect() for df in out]


def test_all_but_the_last_return_documents(steps):
    assert all(tuple(rows[0].__fields__) == pipeline.COLUMNS for rows in steps[:-1])


def test_junk_goes_and_clean_stays(spark, steps):
    left = {r.doc_id for r in steps[1]}
    labels = spark.read.parquet(f"{MEDIUM}/labels.parquet").collect()
    assert sum(x.quality == 1 and x.doc_id not in left for x in labels) <= 2
    assert sum(x.quality == 0 and x.doc_id in left for x in labels) <= 2


def test_one_of_each_group_stays(steps):
    before = steps[1]
    wanted = {i for i, _, c in similar([r.text for r in before], [r.doc_id for r in before], 5, 4, 5) if i == c}
    assert Counter(r.doc_id for r in steps[2]) == Counter(wanted)


def test_repeats_are_cut(steps):
    before = steps[2]
    left = without_windows([r.text for r in before], [r.doc_id for r in before], 50)
    wanted = {r.doc_id: w for r, w in zip(before, left, strict=True) if w or not words(r.text)}
    assert {r.doc_id: words(r.text) for r in steps[3]} == wanted
    whole = {r.doc_id: r.text for r in before}
    assert all(r.text == whole[r.doc_id] for r in steps[3] if len(words(whole[r.doc_id])) == len(words(r.text)))


def test_sources_meet_their_targets(steps):
    size, largest, taken = defaultdict(int), defaultdict(int), defaultdict(int)
    for r in steps[3]:
        size[r.source] += len(words(r.text))
        largest[r.source] = max(largest[r.source], len(words(r.text)))
    for r in steps[4]:
        taken[r.source] += len(words(r.text))
    assert all(abs(taken[s] - t) <= largest[s] for s, t in targets(size).items())
    assert max(Counter(r.doc_id for r in steps[4]).values()) <= 3


def test_tokens_are_the_librarys(steps):
    library = Tokenizer.from_file(vocabulary_path())
    wanted = Counter((r.doc_id, tuple(library.encode(r.text, add_special_tokens=False).ids)) for r in steps[4])
    assert Counter((r.doc_id, tuple(r.ids)) for r in steps[5]) == wanted
    assert all(r.exact and r.n_tokens == len(r.ids) for r in steps[5])


def test_odd_rows_pass_every_stage(spark, tmp_path):
    good = "The quiet river runs past the old mill and the green hills beyond it."
    texts = [None, "", " ", good, good, "w " * 40000, "!!! $$$", None]
    docs = documents(spark, texts, [1, 2, 3, 4, 4, None, None, 5]).withColumnRenamed("n_chars", "n")
    docs = docs.withColumnRenamed("n", "n_chars")
    spark.createDataFrame([(4, 1, 0)], LABEL).write.parquet(f"{tmp_path}/labels.parquet")
    for frame in (docs, docs.limit(0)):
        for name, stage in pipeline.STAGES:
            frame = pipeline.kept(stage(spark, frame, str(tmp_path)), f"odd-{name}")
        rows = frame.collect()
        assert {r.doc_id for r in rows} <= {4, None}
