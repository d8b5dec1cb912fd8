import hashlib
import random
import re

import pytest
from pyspark.sql import functions as F

from granary.llm import exact


def brute(rows):
    norm = [re.sub(r"[\x20\x09-\x0D]", "", t or "") for _, t in rows]
    groups = {}
    for i, n in enumerate(norm):
        groups.setdefault(n, []).append(i)
    out = []
    for members in groups.values():
        best = min(members, key=lambda i: (-len(rows[i][1] or ""), rows[i][0] is None, rows[i][0] or 0))
        for i in members:
            out.append((rows[i][0], rows[best][0], len(members), hashlib.sha256(norm[i].encode()).hexdigest()))
    return sorted(out, key=str)


def found(df):
    return sorted(((r.doc_id, r.keep_id, r.group_size, r.text_sha256) for r in df.collect()), key=str)


@pytest.mark.parametrize("block", [2, 8192])
def test_equals_brute_force(docs, odd_rows, block):
    rnd = random.Random(block)
    texts = ["".join(rnd.choice("ab \n") for _ in range(rnd.randint(0, 9))) for _ in range(150)]
    rows = [*enumerate(texts, 10), *[r for r in odd_rows if r[0] != 6 or block > 1]]
    groups = exact.exact_groups(docs(rows), block_chars=block)
    assert found(groups) == brute(rows)
    assert groups.filter("kept").count() == len({r[3] for r in brute(rows)})


def test_blocks_that_share_a_mark_are_told_apart(docs, monkeypatch):
    real = exact.mark
    weak = lambda block, salt: real(F.substring(block, 1, 1), salt) if salt == 0 else real(block, salt)
    monkeypatch.setattr(exact, "mark", weak)
    rows = [(1, "ax"), (2, "ay"), (3, "a x")]
    assert found(exact.exact_groups(docs(rows))) == brute(rows)


def test_empty_table_and_clashing_columns(docs):
    assert exact.exact_groups(docs([])).collect() == []
    df = docs([(1, "a", 5, "x"), (2, "a ", 6, "y")], "doc_id bigint, text string, _row int, keep_id string")
    assert [tuple(r) for r in exact.drop_exact_copies(df).collect()] == [(2, "a ", 6, "y")]
    with pytest.raises(ValueError, match="_row"):
        exact.exact_groups(df, carry=["_row"])


def test_plan_has_no_python(docs):
    plan = exact.exact_groups(docs([(1, "a b")]))._jdf.queryExecution().toString()
    assert "Python" not in plan and "Pandas" not in plan and "Arrow" not in plan
