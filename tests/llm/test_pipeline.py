from collections import Counter

from pyspark.sql import functions as F

import corpus_pipeline as pipeline
from formbook.llm import mixing, simhash, toxicity
from formbook.llm.common import staged, table
from formbook.llm.queries import tokenizer_file
from test_simhash import brute_components, brute_fingerprint
from test_suffix import brute


def test_stages_against_brute_force(spark):
    """Every stage on what the one before kept."""
    from tokenizers import Tokenizer

    folder = "/root/testdata/sf0.001"
    docs = table(spark, folder, "documents")
    columns, steps = docs.columns, []
    for name, stage in pipeline.STAGES:
        docs = staged(stage(spark, docs, folder), name)
        steps.append(docs.collect())
        assert docs.columns[: len(columns)] == columns
    raw = table(spark, folder, "documents").collect()
    clean, single, cut, mixed, encoded = steps
    frame = table(spark, folder, "documents")
    model = toxicity.fit(toxicity.training_rows(frame, table(spark, folder, "labels")))
    score = {r.doc_id: r.score for r in toxicity.scored(frame, model).collect()}
    assert {r.doc_id for r in clean} == {r.doc_id for r in raw if score[r.doc_id] < 0.7}

    groups = brute_components({r.doc_id: brute_fingerprint(r.text) for r in clean})
    assert sorted(r.doc_id for r in single) == sorted(set(groups.values()))

    want = brute([r.text for r in single], 200)
    assert {r.doc_id: r.text for r in cut} == {r.doc_id: w[3].decode("utf-8", "ignore") for r, w in zip(single, want)}

    plan = mixing.mix(spark.createDataFrame(cut, frame.schema)).collect()
    words = Counter()
    for r in mixed:
        words[r.doc_id] += len((r.text or "").split())
        assert r.n_chars == len(r.text)
    assert {i: n for i, n in words.items() if n} == {r.id: r.taken for r in plan if r.taken}

    library = Tokenizer.from_file(tokenizer_file())
    assert Counter((r.doc_id, r.text) for r in encoded) == Counter((r.doc_id, r.text) for r in mixed)
    for r in encoded:
        assert list(r.ids) == library.encode(r.text, add_special_tokens=False).ids and r.n_tokens == len(r.ids)
        assert r.decoded == library.decode(list(r.ids), skip_special_tokens=False)


def test_run_is_registered(spark):
    import __spark_entry__ as entry

    assert entry.queries()["pipeline"] is pipeline.run
    done = pipeline.run(spark, "/root/testdata/sf0.001")
    assert done.filter(F.col("n_tokens") > 0).count() > 0
