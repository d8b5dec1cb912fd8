import importlib
import sys

import corpus_pipeline
import public_tokenizers
from pyspark.sql import functions as F
from test_decontaminate import leaks_of
from test_exact import brute
from test_jaccard import first_of_each
from tokenizers import Tokenizer

from granary.llm import quality
from granary.llm.common import stored, table
from granary.llm.labelled import labelled_sample

SF = "/root/testdata/sf0.001"


def rows_of(df):
    return sorted((r.doc_id, r.text) for r in df.collect())


def test_stages_equal_brute_force(llm):
    docs = table(llm, SF, "documents")
    columns = docs.columns
    outs = []
    for _, stage in corpus_pipeline.STAGES:
        outs.append(docs := stored(stage(llm, docs, SF), "stage"))
    assert all(o.columns == columns for o in outs[:-1])
    good, unique, apart, clean, encoded = outs
    sample = labelled_sample(table(llm, SF, "documents"), table(llm, SF, "labels"), "quality", 4, 2, quality.PER_CLASS)
    model = quality.train(sample)
    rows = rows_of(table(llm, SF, "documents"))
    kept = [r for r, s in zip(rows, model.scores([t for _, t in rows])) if s >= 0.7]
    assert rows_of(good) == kept and len(kept) < len(rows)
    stay = {keep for _, keep, _, _ in brute(kept)}
    kept = [r for r in kept if r[0] in stay]
    assert rows_of(unique) == kept
    kept = sorted(first_of_each(kept))
    assert rows_of(apart) == kept
    items = [tuple(r) for r in table(llm, SF, "benchmark").select("item_id", "text").collect()]
    short = [r for r in kept if len(r[1]) < 8000]
    leaking = {i for i, _ in leaks_of(short, items)}
    left = rows_of(clean)
    assert [r for r in left if r in short] == [r for r in short if r[0] not in leaking]
    own = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    assert {r.doc_id: r.ids for r in encoded.collect()} == {
        i: own.encode(t, add_special_tokens=False).ids for i, t in left}


def test_odd_rows_pass_through(llm, docs, odd_rows, tmp_path):
    for name in ("labels", "benchmark"):
        table(llm, SF, name).write.parquet(f"{tmp_path}/{name}.parquet")
    extra = docs(odd_rows).select("*", *[F.lit(1).alias(c) for c in ("_row", "name", "key", "half")])
    extra.write.parquet(f"{tmp_path}/documents.parquet")
    for _, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(llm, extra, str(tmp_path)).columns == extra.columns
        assert stage(llm, extra.limit(0), str(tmp_path)).collect() == []
    assert corpus_pipeline.run(llm, str(tmp_path)).count() <= len(odd_rows)


def test_entry_works_without_the_text_operators(monkeypatch):
    hidden = [m for m in sys.modules if m == "corpus_pipeline" or m.startswith("granary.llm")]
    for name in hidden:
        monkeypatch.delitem(sys.modules, name)
    for name in ("corpus_pipeline", "granary.llm"):
        monkeypatch.setitem(sys.modules, name, None)
    monkeypatch.delitem(sys.modules, "__spark_entry__", raising=False)
    entry = importlib.import_module("__spark_entry__")
    assert entry.queries() and not [q for q in entry.queries() if q.startswith("op") or q == "pipeline"]
