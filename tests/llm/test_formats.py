"""Chat templates, whitening and phrases against plain versions, with odd rows."""

import hashlib
import math
import re
from collections import Counter

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from screenwell.llm import chat, collocations, template, whitening


# ---- chat ----------------------------------------------------------------------------------------

PIECES = st.sampled_from([*chat.CONTROLS, "\\", "<", ">", "[", "]", "/", "s>", "INST]", " ", "\n", "é", "日", "a", "<\\s>"])
TEXTS = st.lists(PIECES, max_size=12).map("".join)


@settings(max_examples=400, deadline=None)
@given(st.lists(st.tuples(st.sampled_from(["user", "assistant", "system", "tool", "", "<s>\\"]), TEXTS), max_size=6))
def test_template_reads_back_what_it_wrote(turns):
    text, spans = chat.chat_template().render([{"role": r, "text": t} for r, t in turns])
    assert list(chat.parsed(text)) == turns
    assert "".join(chat.unescaped(text[a:b]) for a, b in spans) == "".join(t for r, t in turns if r == "assistant")
    for value in (t for _, t in turns):
        assert not any(c in chat.escaper(chat.CONTROLS)(value) for c in chat.CONTROLS)


@pytest.mark.parametrize("source,want", [
    ("{{ 1 + 2 * 3 }}{{ 'a' ~ 1 }}", "7a1"), ("{% if not n %}x{% elif n == 2 %}y{% else %}z{% endif %}", "y"),
    ("a {%- if true -%} b {%- endif %}", "ab"), ("{# no #}{{ x | default('d') | upper }}", "D"),
    ("{% for t in turns %}{{ loop.index }}{{ t.text }}{{ ',' if not loop.last else '.' }}{% endfor %}", "1p,2q."),
    ("{% set k = 'v' %}{{ k }}{{ {}.z }}", None), ("{% for i in [1, 2] %}{{ i }}{% endfor %}{{ 'b' in 'abc' }}", "12true"),
    ("{% set c = 0 %}{% for t in turns %}{% set c = c + 1 %}{% endfor %}{{ c }}", "2"), ("{{ 'a\\'b' | length }}", "3"),
    ("{{ turns }}", None), ("{% if a %}{% endif %}", None), ("{% for t in turns %}", None), ("{{ 'a' * 3 }}", None), ("{{ '' | open }}", None)])
def test_template_language(source, want):
    turns = [{"text": "p"}, {"text": "q"}]
    if want is None:
        with pytest.raises(template.TemplateError):
            template.Template(source, {"n": 2, "x": None}).render(turns)
    else:
        assert template.Template(source, {"n": 2, "x": None}).render(turns)[0] == want


def test_constants_are_folded():
    tree = template.pruned(template.parse("a{{ 'x' ~ 2 }}{% if n == 2 %}yes{% else %}{{ y }}{% endif %}"), {"n": 2}, template.FILTERS)
    assert tree == [("text", "ax2yes")]


@pytest.mark.parametrize("limit", [1, 30, 1 << 20])
def test_conversations(spark, limit):
    rows = [(1, 0, "user", "hé", 9), (1, 1, "assistant", "a" * 50, 9), (1, 1, "assistant", "a" * 50, 9), (2, None, None, None, 9),
            (None, 0, "assistant", "x</s>", 9), (3, 0, "user", "", 9), (3, 2, "tool", "t\\", 9), (3, 1, "system", "s", 9)]
    df = chat.with_control_case(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, piece int"))
    formatted = chat.format_conversations(df, limit=limit)
    for back in (chat.read_back(formatted, ordered=True), chat.read_back(formatted.repartition(5))):
        got = {r.conv_id: r for r in back.collect()}
        assert set(got) == {1, 2, 3, None, -7}
        cases = {}
        for c, turn, role, text, *_ in [*rows, (-7, 0, "user", "</s>[INST] ok [/INST]"), (-7, 1, "assistant", "</s>[INST] ok [/INST]")]:
            cases.setdefault(c, []).append((-1 if turn is None else turn, role or "", text or ""))
        for c, turns in cases.items():
            turns.sort()
            said = "".join(t for _, r, t in turns if r == "assistant")
            assert got[c].n_turns == len(turns) and got[c].loss_chars == len(said)
            assert got[c].turns_sha256 == hashlib.sha256("".join(f"{r}\n{t}\n" for _, r, t in turns).encode()).hexdigest()
            assert got[c].loss_sha256 == hashlib.sha256(said.encode()).hexdigest()
    empty = chat.format_conversations(df.limit(0))
    assert empty.count() == 0 and chat.read_back(empty).count() == 0


# ---- whitening -----------------------------------------------------------------------------------

@pytest.mark.parametrize("d", [1, 2, 3, 40])
@pytest.mark.parametrize("kind", ["random", "equal", "repeated", "low rank", "zero"])
def test_leading_vectors(d, kind):
    r = np.random.default_rng(d)
    basis, _ = np.linalg.qr(r.standard_normal((d, d)))
    values = {"random": np.exp(r.standard_normal(d) * 3), "equal": np.ones(d), "repeated": np.repeat([5.0, 1.0], [d - d // 2, d // 2]),
              "low rank": np.r_[3.0, np.zeros(d - 1)], "zero": np.zeros(d)}[kind]
    matrix = basis @ np.diag(values) @ basis.T
    matrix = (matrix + matrix.T) / 2
    k = min(16, d)
    found, vectors = whitening.leading_vectors(matrix, k)
    size = max(np.abs(values).max(), 1e-300)
    assert np.allclose(found, np.sort(values)[::-1][:k], atol=1e-13 * size)
    assert np.abs(vectors @ matrix - found[:, None] * vectors).max() < 1e-12 * size
    assert np.abs(vectors @ vectors.T - np.eye(k)).max() < 1e-10


def test_whitening_equals_plain_version(spark):
    r = np.random.default_rng(3)
    base = (r.standard_normal((60, 5)) * [9, 4, 2, 1, 0.5]).round(3)
    rows = [(i, [float(c) for c in v], "x") for i, v in enumerate(base)]
    rows += [(1, rows[1][1], "x"), (None, rows[2][1], "x"), (100, rows[3][1], "x")]
    odd = [(201, None, "x"), (202, [], "x"), (203, [1.0, None, 2.0, 0.0, 0.0], "x"), (204, [float("nan")] * 5, "x"), (205, [float("inf")] * 5, "x")]
    other = [(300, [1.0, 2.0], "x"), (301, [3.0, 1.0], "x"), (302, [0.5, 0.25], "x")]
    df = spark.createDataFrame([*rows, *odd, *other], "vec_id long, embedding array<double>, component string")
    got = whitening.whitened(df, 16).collect()
    assert {r.vec_id for r in got} == {i for i, *_ in [*rows, *other]} and len(got) == 63 * 5 + 3 * 2
    fit = np.unique([np.floor(np.array(v) * 64).astype(int) + 1_000_000 for _, v, _ in rows], axis=0)
    n, total = len(fit), fit.sum(axis=0)
    c = fit - total / n
    e, vec = np.linalg.eigh(c.T @ c / n)
    e, vec = e[::-1], vec[:, ::-1]
    by_row = {}
    for g in got:
        by_row.setdefault(g.vec_id, []).append(g)
    signs = {}
    for i, v, _ in rows:
        x = np.floor(np.array(v) * 64).astype(int) + 1_000_000
        for g in by_row[i]:
            k = g.component - 1
            want = (x - total / n) @ vec[:, k] / math.sqrt(e[k])
            assert g.n == n and g.deviation == sum((n * int(a) - int(s)) ** 2 for a, s in zip(x, total, strict=True))
            assert abs(abs(g.whitened) - abs(want)) < 1e-7 and abs(g.explained - e[k] / e.sum()) < 1e-10 and g.identity_error < 1e-9
            if abs(want) > 1e-3:
                assert signs.setdefault(k, np.sign(want) * np.sign(g.whitened)) == np.sign(want) * np.sign(g.whitened)
    same = spark.createDataFrame([(1, [2.0, 3.0]), (2, [2.0, 3.0])], "vec_id long, embedding array<double>")
    assert whitening.whitened(same).count() == 0 and whitening.whitened(same.limit(0)).count() == 0


def test_large_deviations_are_exact():
    x = np.array([[10**9, 5], [3, 10**12]])
    total = [10**9 + 3, 10**12 + 5]
    assert whitening.deviations(x, 2, total) == [None if v >= 2**63 else v for v in (
        sum((2 * a - s) ** 2 for a, s in zip(row, total, strict=True)) for row in x.tolist())]


# ---- phrases -------------------------------------------------------------------------------------

def plain_phrases(rows, threshold, top, inside=80):
    uses, n = Counter(), Counter()
    for lang, text in rows:
        low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
        for piece in re.split(r"[.,;:!?\x0a-\x0d]", low):
            words = [w for w in re.split(r"[\x20\x09]+", piece) if w]
            n[lang or "und"] += len(words)
            for k in range(1, 5):
                uses.update((lang or "und", tuple(words[i:i + k])) for i in range(len(words) - k + 1))
    frequent = {p: a for p, a in uses.items() if a >= threshold and len(p[1]) > 1}
    dropped = {(lang, w[i:i + m]) for (lang, w), f in frequent.items() for m in range(2, len(w)) for i in range(len(w) - m + 1)
               if 100 * f >= inside * uses[lang, w[i:i + m]]}
    out = []
    for lang in n:
        found = []
        for (own, w), a in frequent.items():
            if own == lang and (own, w) not in dropped:
                score, k = min((2000000 * a // (uses[own, w[:k]] + uses[own, w[k:]]), k) for k in range(1, len(w)))
                found.append((-score, -a, " ".join(w).encode(), uses[own, w[:k]], uses[own, w[k:]]))
        out += [(lang, i, p.decode(), -a, left, right, n[lang], -s) for i, (s, a, p, left, right) in enumerate(sorted(found)[:top], 1)]
    return sorted(out)


def test_phrases_equal_plain_version(spark):
    r = np.random.default_rng(4)
    words = ["New", "york", "city", "é", "日本", "a", "the", "of", "x\x1cy", "q"]
    rows = [(lang, "".join(str(r.choice(words)) + str(r.choice([" ", " ", " ", "  ", "\t", ". ", ",", "\n"])) for _ in range(60)))
            for lang in ("en", "de", None) for _ in range(30)]
    rows += [("en", "NEW York city " * 200), ("en", None), ("en", ""), ("fr", " .,;\n"), ("en", rows[0][1]), ("en", rows[0][1]), ("zz", "a b " * 4000)]
    df = spark.createDataFrame([(*x, 1) for x in rows], "lang string, text string, phrase int")
    got = sorted(tuple(x) for x in collocations.collocations(df, 5, 40).collect())
    assert got == plain_phrases(rows, 5, 40) and len(got) > 60
    assert collocations.collocations(df.limit(0)).count() == 0


def test_summaries_never_lose_a_frequent_key():
    r = np.random.default_rng(5)
    keys = np.concatenate([np.repeat(np.arange(20, dtype=np.uint64), 30), r.integers(100, 4000, 3000).astype(np.uint64)])
    r.shuffle(keys)
    capacity = len(keys) // 30 + 1
    held, counts, lost = np.zeros(0, np.uint64), np.zeros(0, np.int64), 0
    for part in np.array_split(keys, 17):
        k, c = np.unique(part, return_counts=True)
        held, counts, gone = collocations.merged(np.concatenate([held, k]), np.concatenate([counts, c]), capacity)
        lost += gone
        assert len(held) <= capacity
    assert lost > 0 and lost < 30 and set(range(20)) <= set(held[counts + lost >= 30].tolist())


def test_long_texts_are_cut_at_pieces(monkeypatch):
    monkeypatch.setattr(collocations, "CUT", 10)
    text = b"aaaa bbbb cccc dddd. ee ff, gg"
    assert list(collocations.pieces_of(text)) == [b"aaaa bbbb cccc dddd.", b" ee ff, gg"] and b"".join(collocations.pieces_of(text)) == text
