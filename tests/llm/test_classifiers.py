import pytest
from pyspark.sql import functions as F

from granary.llm import quality, toxicity
from granary.llm.common import fold, table
from granary.llm.labelled import labelled_sample
from granary.llm.queries import LLM_QUERIES

LABELS = "doc_id bigint, quality int, toxic int"
SF = "/root/testdata/sf0.01"


@pytest.mark.parametrize("name,label,least", [("op1_quality", "quality", 0.93), ("op3_toxicity", "toxic", 0.9)])
def test_held_out_accuracy(llm, name, label, least):
    got = LLM_QUERIES[name](llm, SF).join(table(llm, SF, "labels"), "doc_id").filter("held_out").toPandas()
    assert (got["predicted"] == got[label]).mean() >= least
    assert got["score"].between(0, 1).all()


def test_sample_is_bounded_and_never_held_out(docs):
    rows = [(i, f"text {i}") for i in range(200)] + [(None, "x")]
    labels = docs([(i, i % 2, 0) for i in range(200)] + [(0, 1, 1), (7, None, None), (None, 1, 1), (900, 1, 1)], LABELS)
    sample = labelled_sample(docs(rows), labels, "quality", 4, 2, 20).collect()
    assert sorted(r.y for r in sample) == [0] * 20 + [1] * 20
    kept = labelled_sample(docs(rows), labels, "quality", 4, 2, 1000).collect()
    held = {r.doc_id for r in docs(rows).filter(fold(F.col("doc_id"), 4) == 2).collect()}
    assert held and not held & {int(r.text.split()[1]) for r in kept}
    assert next(r.y for r in kept if r.text == "text 0") == 1


def test_one_id_of_very_many_rows_counts_once(docs):
    rows = [(i, f"text {i}") for i in range(40)] + [(1, f"again {k}") for k in range(500)]
    labels = docs([(i, i % 2, 0) for i in range(40)], LABELS)
    sample = labelled_sample(docs(rows), labels, "quality", 4, 2, 1000).collect()
    held = docs(rows).filter(fold(F.col("doc_id"), 4) == 2).select("doc_id").distinct().count()
    assert len(sample) == 40 - held and sum(r.text.startswith("again") for r in sample) <= 1


@pytest.mark.parametrize("module,call", [(quality, quality.quality), (toxicity, toxicity.toxicity)])
def test_odd_rows_without_labels_and_empty_tables(docs, odd_rows, module, call):
    none = labelled_sample(docs(odd_rows), docs([], LABELS), "toxic", 5, 0, 10)
    got = call(docs(odd_rows), module.train(none), F.lit(False), 0.5).collect()
    assert len(got) == len(odd_rows) and {(r.score, r.predicted) for r in got} == {(0.0, 0)}
    rows = [(i, "you scum loser" if i % 2 else "fine words here") for i in range(60)]
    labels = docs([(i, 1 - i % 2, i % 2) for i in range(60)], LABELS)
    model = module.train(labelled_sample(docs(rows), labels, "toxic", 5, 0, 100))
    assert call(docs([]), model, F.lit(False), 0.5).collect() == []
    scores = {r.doc_id: r.score for r in call(docs(rows + [(1000 + k, t) for k, (_, t) in enumerate(odd_rows)]), model, F.lit(False), 0.5).collect()}
    assert scores[1] > 0.5 > scores[0] and all(0 <= s <= 1 for s in scores.values())


def test_dual_coordinate_descent_separates():
    rng = quality.np.random.default_rng(1)
    x = rng.normal(size=(80, 3))
    y = (x[:, 0] + 0.5 * x[:, 1] > 0).astype(int)
    w = quality.dual_coordinate_descent([(quality.np.arange(3), r) for r in x], y, 3)
    assert ((x @ w[:-1] + w[-1] > 0) == (y == 1)).mean() > 0.9


def test_keep_good_returns_all_columns(docs):
    df = docs([(1, "a", 2)], "doc_id bigint, text string, _score int")
    model = quality.NaiveBayesSvm(*[quality.np.zeros(0, dtype=quality.np.uint64)] * 2, quality.np.zeros(1), quality.np.array([0.0, 5.0]))
    assert [tuple(r) for r in quality.keep_good(df, model, 0.7).collect()] == [(1, "a", 2)]


def test_class_models_add_up():
    np = toxicity.np
    grams = sorted({toxicity.padded(w)[i : i + 8] for w in ("ab", "ac", "b") for i in range(len(w) + 1)})
    codes = toxicity.codes_of("".join(grams)).reshape(-1, toxicity.ORDER)
    shared = toxicity.shared_model(codes)
    sums = {}
    for gram, p in zip(grams, shared):
        sums[gram[1:-1]] = sums.get(gram[1:-1], 0) + p
    assert all(0 < s <= 1 + 1e-9 for s in sums.values())
    n = np.array([[(i * 7 + p) % 3 for i in range(len(grams))] for p in range(4)])
    model = toxicity.fit(toxicity.Grams(codes, n), (0, 1, 2, 3))
    assert model.features(["ab ac", ""]).shape == (2, 3)
