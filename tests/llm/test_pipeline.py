import hashlib
import random

import public_tokenizers
import pytest
import tiktoken

import corpus_pipeline
from plumbline.llm import bpe, pii

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


@pytest.fixture(scope="module")
def world(spark, tmp_path_factory):
    folder = str(tmp_path_factory.mktemp("tables"))
    rng = random.Random(15)
    vocabulary = ["".join(rng.choice("abcdefgh") for _ in range(rng.randint(1, 5))) for _ in range(400)]

    def prose(n):
        return " ".join(rng.choices(vocabulary, [1 / (i + 1) for i in range(400)], k=n))

    passage = prose(40)
    rows = [(i, prose(rng.randint(80, 160)), "en", "s") for i in range(300)]
    rows[10] = (10, rows[10][1] + " mail me at rob.7@example.com or rob[at]example.com", "en", "s")
    rows.append((400, " ".join(w.upper() + "!!" for w in prose(90).split()), "en", "s"))
    rows.append((401, rows[5][1] + " " + vocabulary[0], "en", "s"))
    rows.append((402, prose(60) + " " + passage, "en", "s"))
    rows += [(403, None, None, None), (None, prose(90), "en", None), (7, rows[7][1], "en", "s"), (8, prose(100), "en", "s")]
    docs = spark.createDataFrame([(*r, None if r[1] is None else len(r[1])) for r in rows], "doc_id long, text string, lang string, source string, n_chars long")
    docs.write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame([(i, 1, 0) for i in range(200)], "doc_id long, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
    spark.createDataFrame([(1, passage)], "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
    return folder, rows


def test_decisions(spark, world):
    folder, rows = world
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    ids = lambda df: sorted((r.doc_id for r in df.collect()), key=str)
    names = [name for name, _ in corpus_pipeline.STAGES]
    assert names == ["quality", "near-duplicates", "decontamination", "pii", "bpe"]
    for name, stage in corpus_pipeline.STAGES[:-1]:
        before = ids(docs)
        docs = corpus_pipeline.materialise(stage(spark, docs, folder), "test")
        assert docs.columns == COLUMNS
        gone = set(before) - set(ids(docs))
        if name == "quality":
            assert {400, 403} <= gone and len(gone) <= 6
        elif name == "near-duplicates":
            assert 401 in gone and len(gone) <= 2 and len(before) - docs.count() == len(gone) + 1
            assert sum(r.doc_id == 8 for r in docs.collect()) == 2 and None in ids(docs)
        elif name == "decontamination":
            assert gone == {402}
        else:
            assert not gone
            text = {r.doc_id: r for r in docs.collect()}[10]
            assert text.text == pii.redact(rows[10][1]) and "rob" not in text.text[-40:] and text.n_chars == len(text.text)
    result = corpus_pipeline.run(spark, folder)
    with open(public_tokenizers.path("byte_bpe_50k.tiktoken"), "rb") as file:
        ranks = bpe.read_ranks(file.read())
    library = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    want = sorted(hashlib.sha256(" ".join(map(str, library.encode_ordinary(r.text))).encode()).hexdigest() for r in docs.collect())
    assert sorted(r.ids_sha256 for r in result.collect()) == want


def test_empty(spark, world):
    folder, _ = world
    docs = spark.read.parquet(f"{folder}/documents.parquet").limit(0)
    for _, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, folder)
        assert docs.columns == COLUMNS and docs.count() == 0


def test_rows_of_one_id_are_judged_apart(spark, world):
    """A clean row stays, whatever another row of its id holds."""
    folder, rows = world
    passage = next(r[1] for r in rows if r[0] == 402).split(" ")[-40:]
    clean = rows[50][1]
    some = [(i, rows[i][1]) for i in range(40)]
    own = [(7000, " ".join(passage)), (7000, clean), (None, clean + " x"), (7001, rows[60][1]), (7001, rows[60][1] + " a")]
    docs = spark.createDataFrame([(i, t, "en", "s", len(t), "k") for i, t in some + own], "doc_id long, text string, lang string, source string, n_chars long, row_key string")
    left = corpus_pipeline.decontaminated(spark, docs, folder).collect()
    assert sorted(r.text for r in left if r.doc_id == 7000) == [clean] and len(left) == 44
    left = corpus_pipeline.one_of_each(spark, docs, folder)
    assert left.columns == [*COLUMNS, "row_key"]
    left = left.collect()
    assert {r.text for r in left if r.doc_id == 7000} == {" ".join(passage), clean} and None not in {r.doc_id for r in left}
    assert sum(r.doc_id == 7001 for r in left) == 1


def test_without_a_package_the_other_queries_stay(tmp_path):
    import subprocess
    import sys
    from pathlib import Path

    root = Path(corpus_pipeline.__file__).parent
    code = "import sys; sys.modules['sentencepiece'] = None; import __spark_entry__ as e; q = e.queries(); print('pipeline' in q, 'gains_table' in q)"
    out = subprocess.run([sys.executable, "-W", "ignore", "-c", code], cwd=root, capture_output=True, text=True)
    assert out.stdout.split() == ["False", "True"]
