import random
import re

from granary.llm import lines

STEP, MIX, ALL = 0x9E3779B97F4A7C15, 0xFF51AFD7ED558CCD, (1 << 64) - 1


def lower(word):
    return "".join(c.lower() if len(c.lower()) == 1 else c for c in word)


def mixed(x):
    x = (x ^ x >> 32) * MIX & ALL
    return x ^ x >> 29


def word_hash(word):
    """The hash that borders depend on, letter by letter."""
    total = sum(mixed((ord(c) + 1) * STEP & ALL) * pow(STEP, k, 1 << 64) for k, c in enumerate(word))
    return mixed((total + len(word)) & ALL)


def words_of(text):
    return [lower(m[0]) for m in re.finditer(r"\w+", text)]


def units(text):
    """Pieces as (start, words) and sentences as (first piece, words), by a plain scan."""
    found = [(m.start(), m.end(), lower(m[0])) for m in re.finditer(r"\w+", text)]
    hashes = [word_hash(w) for *_, w in found]
    pieces, sentences = [], []
    for k, (start, _, word) in enumerate(found):
        new = k == 0 or re.search(r"[.!?\n]", text[found[k - 1][1] : start])
        before, after = hashes[max(0, k - lines.AROUND) : k], hashes[k + 1 : k + 1 + lines.AROUND]
        if new or (all(hashes[k] < h for h in before) and all(hashes[k] <= h for h in after)):
            pieces.append((start, []))
        if new:
            sentences.append((len(pieces) - 1, []))
        pieces[-1][1].append(word)
        sentences[-1][1].append(word)
    return pieces, sentences


def brute(rows, least=lines.LEAST_WORDS):
    """Removed spans of rows (id, text), by plain dictionaries."""
    texts = [units(t or "") for _, t in rows]
    first = {}
    order = sorted(range(len(rows)), key=lambda r: (rows[r][0] is None, rows[r][0] or 0, r))
    for r in order:
        pieces, sentences = texts[r]
        for k in range(len(pieces) - 1):
            first.setdefault((tuple(pieces[k][1]), tuple(pieces[k + 1][1])), (r, k))
        for k, (_, words) in enumerate(sentences):
            first.setdefault(tuple(words), (r, k))
    out = []
    for r, (i, text) in enumerate(rows):
        pieces, sentences = texts[r]
        ends = [p[0] for p in pieces[1:]] + [len(text or "")]
        size = lambda a, b: sum(len(pieces[k][1]) for k in range(a, b))
        kept = [first[tuple(pieces[k][1]), tuple(pieces[k + 1][1])] for k in range(len(pieces) - 1)]
        again = [f != (r, k) for k, f in enumerate(kept)]
        taken, done, k = set(), 0, 0
        while k < len(kept):
            if not again[k]:
                k += 1
                continue
            last = k
            while last + 1 < len(kept) and again[last + 1] and kept[last + 1] == (kept[last][0], kept[last][1] + 1):
                last += 1
            a, b = max(k, done), last + 2
            if size(a, b) >= least:
                out.append((i, pieces[a][0], ends[b - 1], size(a, b), rows[kept[k][0]][0], "passage"))
                taken |= set(range(a, b))
                done = b
            k = last + 1
        for s, (at, words) in enumerate(sentences):
            if len(words) < lines.LEAST_UNIT or first[tuple(words)] == (r, s):
                continue
            stop = sentences[s + 1][0] if s + 1 < len(sentences) else len(pieces)
            free = [p for p in range(at, stop) if p not in taken]
            while free:
                b = next((p for p, q in zip(free, [*free[1:], None]) if q != p + 1), free[-1]) + 1
                out.append((i, pieces[free[0]][0], ends[b - 1], size(free[0], b), rows[first[tuple(words)][0]][0], "sentence"))
                free = [p for p in free if p >= b]
    return sorted(out, key=str)


def found(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def one_task(docs, rows):
    return docs(rows).coalesce(1)


def test_cutting_equals_a_plain_scan():
    texts = ["One two. three!\n\nFour... 5\t? .. end", "", " .\n", "a", "İstanbul ÀÉ_x ÿ\U0001f600漢字 b. c d e f g h",
             " ".join(f"w{k * k % 97}" for k in range(400)), "go. " * 30]
    cut = lines.Cut(texts)
    for i, text in enumerate(texts):
        start, words, pair, first, count, long, whole = cut.arrays(i)
        pieces, sentences = units(text)
        assert list(zip(start, words)) == [(s, len(w)) for s, w in pieces]
        assert list(zip(first, long)) == [(s, len(w)) for s, w in sentences]
        assert sum(count) == len(pieces) and len(pair) == len(pieces) and len(whole) == len(sentences)


def test_equals_brute_force(docs, documents, odd_rows, monkeypatch):
    monkeypatch.setattr(lines, "CODES_AT_ONCE", 3000)
    monkeypatch.setattr(lines, "DIGESTS_AT_ONCE", 500)
    rnd = random.Random(1)
    passage = ". ".join(" ".join(f"p{rnd.randint(0, 500)}" for _ in range(9)) for _ in range(7)) + "."
    rows = documents + [(500 + k, f"own{k} start. {passage} own{k} end.") for k in range(5)] + odd_rows
    rnd.shuffle(rows)
    got = found(lines.repeated_text(one_task(docs, rows)))
    assert got == brute(rows)
    assert {g[0] for g in got if g[5] == "passage"} >= {501, 502, 503, 504}
    assert 500 not in {g[0] for g in got}


def test_spans_do_not_overlap_and_passages_occur_before_as_a_whole(docs, documents):
    texts = dict(documents)
    spans = {}
    for i, start, end, n, first, kind in found(lines.repeated_text(docs(documents))):
        words = words_of(texts[i][start:end])
        assert len(words) == n and start < end <= len(texts[i])
        assert all(end <= a or b <= start for a, b in spans.get(i, []))
        spans.setdefault(i, []).append((start, end))
        if kind == "passage":
            assert n >= lines.LEAST_WORDS and (first, 0) <= (i, start)
            kept = texts[first] if first != i else texts[i][:end]
            assert f" {' '.join(words)} " in f" {' '.join(words_of(kept))} "
    seen = set()
    for i, text in sorted(documents):
        pieces, sentences = units(text)
        for k, (at, words) in enumerate(sentences):
            if len(words) >= lines.LEAST_UNIT and tuple(words) in seen:
                stop = sentences[k + 1][0] if k + 1 < len(sentences) else len(pieces)
                for start, _ in pieces[at:stop]:
                    assert any(a <= start < b for a, b in spans[i])
            seen.add(tuple(words))


def test_texts_without_their_repeats(docs):
    passage = " ".join(f"p{k}" for k in range(55)) + "."
    line = "The same line again."
    rows = [(1, f"Head one. {passage} Tail a.\n{line}"), (2, f"Head two. {passage} Tail b.\n{line}\nEnd"), (3, None)]
    got = {r.doc_id: r for r in lines.without_repeats(one_task(docs, rows)).collect()}
    assert got[1].text == rows[0][1] and got[1].removed == []
    assert got[2].text == "Head two. Tail b.\nEnd" and got[3].text == ""
    text = rows[1][1]
    assert [text[s.start : s.end] for s in got[2].removed] == [f"{passage} ", f"{line}\n"]
    got = {r.doc_id: r.text for r in lines.without_repeats(one_task(docs, rows), short=False).collect()}
    assert got[2] == f"Head two. Tail b.\n{line}\nEnd"


def test_passages_inside_sentences(docs):
    rnd = random.Random(4)
    word = lambda: f"w{rnd.randint(0, 10**6)}"
    for sizes in ([60], [20, 40], [12, 5, 12, 31], [30, 28, 15], [52]):
        passage = ". ".join(" ".join(word() for _ in range(n)) for n in sizes)
        rows = [(i, " ".join([*(word() for _ in range(9 + i)), passage, *(word() for _ in range(15 - i))])) for i in range(4)]
        got = found(lines.repeated_passages(one_task(docs, rows)))
        assert [g[0] for g in got] == [1, 2, 3] and all(g[4] == 0 for g in got)
        for i, start, end, n, _ in got:
            assert rows[i][1][start:end].strip() in passage and n >= sum(sizes) - 22


def test_clean_texts_have_no_spans(docs):
    rnd = random.Random(9)
    rows = [(i, ". ".join(" ".join(f"w{rnd.randint(0, 3000)}" for _ in range(12)) for _ in range(20))) for i in range(60)]
    assert lines.repeated_text(docs(rows)).collect() == []


def test_ids_of_other_types_and_empty_table(docs, odd_rows):
    assert lines.repeated_text(docs([])).collect() == []
    line = "one line of five words"
    text_ids = docs([("b", line), ("a", line), (None, line), ("a", line)], "doc_id string, text string")
    got = found(lines.repeated_text(text_ids.coalesce(1)))
    assert got == sorted([("b", 0, 22, 5, "a", "sentence"), (None, 0, 22, 5, "a", "sentence"), ("a", 0, 22, 5, "a", "sentence")], key=str)
    extra = docs(odd_rows).selectExpr("*", "1 AS _row", "2 AS _rank", "3 AS kept", "4 AS start").coalesce(1)
    assert found(lines.repeated_text(extra)) == brute(odd_rows)


def test_one_text_in_a_third_of_the_rows(docs):
    rows = [(i, "the very same text of some words. " * 9 if i % 3 == 0 else f"own{i} text{i} of{i}") for i in range(300)]
    got = found(lines.repeated_text(docs(rows).repartition(7)))
    assert len({g[0] for g in got}) == 100 and {g[4] for g in got} == {0}


def test_the_query_returns_shorter_repeats(llm, docs, tmp_path):
    from granary.llm.queries import op6_substring_dedup

    rows = [(k, f"Own{k} a{k} b{k}.\nThe same line of eight words comes again\n") for k in range(3)]
    docs(rows).write.parquet(f"{tmp_path}/documents.parquet")
    got = found(op6_substring_dedup(llm, str(tmp_path)))
    assert [(g[0], g[3], g[4], g[5]) for g in got] == [(1, 8, 0, "sentence"), (2, 8, 0, "sentence")]
