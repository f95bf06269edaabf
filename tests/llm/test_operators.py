"""The operators against plain versions, with nulls, empty and long texts, ties and repeated rows."""

import random
import struct
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from screenwell.llm import (
    bpe_tree, decontaminate, embeddings, jaccard, language, privacy, quality, substrings, suffixes, warc, wrappers,
)
from tests.llm import brute

ODD = [(9001, None), (9002, ""), (9003, " \n\t "), (9004, "one"), (None, "a row without an id"), (9004, "one")]


def texts(n, words=60, seed=1):
    r = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(300)]
    out = []
    while len(out) < n:
        base = [r.choice(vocabulary) for _ in range(r.choice([1, 2, 4, 30, words]))]
        for _ in range(r.choice([1, 2, 6])):
            out.append(" ".join(w if r.random() > 0.01 else r.choice(vocabulary) for w in base))
    return list(enumerate(out[:n], 1))


def table(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, text string")


def test_tree_concatenation_equals_the_library():
    enc = bpe_tree.Encoder(bpe_tree.vocabulary_path(), leaf=8)
    r = random.Random(2)
    parts = ["a", "b", "th", "ing", "é", "!", "1", "'s", "日", "ß", "İ", "<|endoftext|>", "́", " ", "\n", "\xa0", "X", "q" * 9]
    for _ in range(1500):
        text = "".join(r.choice(parts) for _ in range(r.randint(0, 50)))
        want = enc.whole.encode(text, add_special_tokens=False).ids
        ids, decoded = enc.encode(text)
        assert list(struct.unpack(f"<{len(ids) // 4}I", ids)) == want
        assert decoded == enc.whole.decode(want, skip_special_tokens=False)
        leaves = [bpe_tree.encode_leaf(enc, x) for x in bpe_tree.halves(text, 7)]
        assert bpe_tree.join_leaves(enc, leaves) == (ids, decoded)
        run = "".join(r.choice("thingaeiou") for _ in range(r.randint(10, 120)))
        assert enc.run(run) == enc.whole.encode(run, add_special_tokens=False).ids


def test_encoded_documents(spark):
    rows = ODD + [(1, "x" * 3000), (2, "Ab cd. " * 900)]
    got = bpe_tree.encode_documents(table(spark, rows), leaf_chars=500).collect()
    whole = bpe_tree.Encoder(bpe_tree.vocabulary_path()).whole
    want = [bpe_tree.digest(i, struct.pack(f"<{len(e)}I", *e), whole.decode(e, skip_special_tokens=False))
            for i, e in ((i, whole.encode(t or "", add_special_tokens=False).ids) for i, t in rows)]
    assert sorted(map(str, map(tuple, got))) == sorted(map(str, want))


def test_jaccard_components(spark):
    rows = texts(250) + [r for r in ODD if r[0] is not None][:4]
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in jaccard.link(table(spark, rows)).collect()}
    sets, component = brute.jaccard_components(rows)
    assert got == {i: (len(sets[i]), component[i]) for i in sets}


def test_jaccard_odd_rows(spark):
    got = sorted(map(str, map(tuple, jaccard.link(table(spark, ODD)).collect())))
    assert got == sorted(map(str, [(9001, 0, 9001), (9002, 0, 9002), (9003, 0, 9003), (9004, 1, 9004), (9004, 1, 9004),
                                   (None, 3, None)]))
    assert jaccard.link(table(spark, [])).count() == 0


def test_wide_parity_bits_tell_long_texts_apart(spark):
    """5,000 shingles: 512 bits let two unrelated sets through, two bits a shingle do not, nor sets that
    share 60 %; linked ones always pass, also when their rows have different lengths."""
    r = np.random.default_rng(3)
    own = np.unique(r.integers(0, 2**63, 5000, dtype=np.uint64))
    near = np.concatenate([own[:4050], r.integers(0, 2**63, 46, dtype=np.uint64)])
    some = np.concatenate([own[:3750], r.integers(0, 2**63, 1250, dtype=np.uint64)])
    other = r.integers(0, 2**63, 5000, dtype=np.uint64)
    assert len(jaccard.wide_parity(own)) == 2 * len(jaccard.wide_parity(near))
    assert jaccard.wide_parity(own[:256]) is None
    rows = []
    for k, x in enumerate((own, near, some, other, own[:200])):
        wide = jaccard.wide_parity(x)
        rows.append((k, len(x), *map(int, jaccard.parity(x)), None if wide is None else [int(v) for v in wide]))
    sets = spark.createDataFrame(rows, "id int, n long, " + ", ".join(f"{b} long" for b in jaccard.BITS) + ", wide array<long>")
    pairs = sets.alias("x").join(sets.alias("y"), F.expr("x.id = 0"))
    got = {q.id: (q.first, q.then) for q in pairs.select(
        "y.id", jaccard.near(80, "x", "y").alias("first"), jaccard.wide_near(80, "x", "y").alias("then")).collect()}
    assert got[0] == got[1] == (True, True)
    assert got[2] == got[3] == (True, False)
    assert got[4][1]


def test_groups_of_equal_members_come_once(spark):
    groups = {1: [1, 2, 3], 2: [3, 1, 2], 3: [1, 2], 4: [1, 1, 2], 5: [2, 3, 1], 6: [4]}
    rows = spark.createDataFrame([(k, i) for k, ids in groups.items() for i in ids], "key long, id long")
    assert {q.key for q in jaccard.once(rows, "key").collect()} == {1, 3, 4, 6}


def plain_components(rows, size, percent):
    sets = {i: brute.shingles(t, size) for i, t in rows}
    links = []
    for a in sets:
        for b in sets:
            if a < b and 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b]) > 0:
                links.append((a, b))
    return brute.components(sets, links)


@pytest.mark.parametrize("size,percent,direct", [(3, 90, 128), (5, 80, 3)])
def test_jaccard_with_empty_segments_and_large_groups(spark, size, percent, direct, monkeypatch):
    monkeypatch.setattr(jaccard, "DIRECT", direct)
    r = random.Random(percent)
    rows = []
    for length, copies in ((60, 160), (22, 60), (9, 40), (7, 40), (14, 60), (200, 20)):
        base = [f"b{length}x{r.randrange(10 ** 6)}" for _ in range(length)]
        for _ in range(copies):
            words = list(base)
            for _ in range(r.choice([0, 1, 1, 2, 3])):
                words[r.choice([0, 1, len(words) - 1, r.randrange(len(words))])] = f"n{r.randrange(10 ** 6)}"
            rows.append(" ".join(words[: len(words) - r.choice([0, 0, 1, 2])]))
    passage = [f"p{k}" for k in range(30)]
    rows += [" ".join(passage + [f"q{r.randrange(10 ** 6)}" for _ in range(20)]) for _ in range(80)]
    rows = list(enumerate(rows, 1))
    got = {q.doc_id: q.component_id for q in jaccard.link(table(spark, rows), size, percent).collect()}
    assert got == plain_components(rows, size, percent)


@pytest.mark.parametrize("percent", [60, 80, 90])
def test_linked_sets_share_a_first_key(percent):
    r = np.random.default_rng(percent)
    for _ in range(1500):
        n = int(r.integers(2, 70))
        own = r.integers(0, 2 ** 63, n).astype(np.uint64)
        gone = int(r.integers(0, n // 2 + 1))
        other = np.unique(np.concatenate([own[gone:], r.integers(0, 2 ** 63, int(r.integers(0, n // 2 + 1))).astype(np.uint64)]))
        own = np.unique(own)
        both = len(np.intersect1d(own, other))
        bits = int(sum(int(x).bit_count() for x in (jaccard.parity(own) ^ jaccard.parity(other)).view(np.uint64)))
        assert bits <= len(own) + len(other) - 2 * both
        if 100 * both < percent * (len(own) + len(other) - both) or not len(other) or both == len(own) == len(other):
            continue
        keys = [{int(k) for band, count in jaccard.banded(x, percent) for f in jaccard.first_keys(x, band, count) for k in f}
                for x in (own, other)]
        assert keys[0] & keys[1]


def plain_entries(text, size, percent):
    """(slot, keys) of each band of a text, one text at a time."""
    words = jaccard.words_of([(text or "").encode("utf-8", "replace").translate(jaccard.LOWER)])[0]
    own = jaccard.shingle_hashes(words, size)
    for band, count in jaccard.banded(own, percent):
        full, empty = jaccard.first_keys(own, band, count)
        larger = min(100 * len(own) // percent, jaccard.band_starts(200 * len(own) // percent + 2)[band + 1] - 1)
        spare = jaccard.segments(len(own) + larger, percent, 1) - 1 - len(full)
        yield band * jaccard.SLOT + jaccard.SLOT // 2 + spare, sorted(np.concatenate([full, empty]).tolist())


def edited_texts():
    r = random.Random(4)
    texts = [None, "", " ", "one", "one two", "a b c d e f g h", "x " * 80]
    for length in (6, 20, 50, 90, 400):
        base = [f"w{r.randrange(length)}" for _ in range(length)]
        for _ in range(4):
            texts.append(" ".join(base))
            base[r.randrange(length)] = f"n{r.randrange(10 ** 6)}"
        texts.append(" ".join(f"u{r.randrange(10 ** 9)}" for _ in range(length)))
    return texts


def plain_recurring(entries):
    """(id, slot) -> (spare, rare, rest) from entries (id, slot, keys) with all keys in one place."""
    df, out = Counter(k for _, _, found in entries for k in found), {}
    for i, slot, found in entries:
        here = sorted((k & 1, df[k], k) for k in found if df[k] > 1)
        spare = sum(not odd for odd, _, _ in here) + slot % jaccard.SLOT - jaccard.SLOT // 2
        if here and spare >= 0:
            rare = [k for place, (odd, _, k) in enumerate(here) if odd or place <= spare]
            out[i, slot] = spare, rare, [k for _, _, k in here if k not in rare]
    return out


@pytest.mark.parametrize("size,percent", [(3, 90), (5, 80)])
def test_keys_of_many_texts_as_of_one(size, percent):
    texts, got, known, done = edited_texts(), {}, {}, 0
    for hashes, at in jaccard.hashed_texts(pa.array(texts), size):
        for which, slots, number, keys in jaccard.entries_of(hashes, at, percent, known):
            ends = np.cumsum(number)
            for text, slot, i, j in zip(which, slots, ends - number, ends, strict=True):
                got.setdefault(done + text, []).append((slot, sorted(keys[i:j].tolist())))
        done += len(at) - 1
    assert [got.get(i, []) for i in range(len(texts))] == [list(plain_entries(t, size, percent)) for t in texts]


@pytest.mark.parametrize("size,percent", [(3, 90), (5, 80)])
def test_keys_move_packed_and_those_that_others_have_come_back(spark, size, percent):
    """Under eight bytes a key move; what comes back is what a look at all keys at once gives."""
    texts = edited_texts()
    keys = jaccard.keys_of(spark.createDataFrame(list(enumerate(texts)), "id long, text string").coalesce(1), size, percent, 5).cache()
    sent = keys.where("keys is not null").selectExpr("sum(length(keys)) / 4 n", "sum(length(keys) + length(gaps)) b", "count(heads) h").first()
    entries = [(i, slot, [(k >> 33) % 5 << 32 | k & 0xFFFFFFFF for k in found])
               for i, t in enumerate(texts) for slot, found in plain_entries(t, size, percent)]
    assert sent.n == sum(len(found) for _, _, found in entries) and sent.b < 8 * sent.n and not sent.h
    want = plain_recurring(entries)
    out = jaccard.recurring(keys).cache()
    assert {(q.id, q.slot): (q.spare, q.rare, q.rest) for q in out.collect()} == want and 0 < len(want) < len(entries)
    again = plain_recurring([(i, slot, rare + rest) for (i, slot), (_, rare, rest) in want.items()])
    labels = spark.createDataFrame([(q.id, 7) for q in out.select("id").distinct().collect()], "id long, component long")
    apart = jaccard.recurring(jaccard.keys_again(out, labels.limit(0), 5)).collect()
    assert {(q.id, q.slot): (q.spare, q.rare, q.rest) for q in apart} == again
    assert jaccard.recurring(jaccard.keys_again(out, labels, 5)).count() == 0


def test_edits_against_a_centre_part_a_group(spark):
    """Linked sets, one of them not linked with the centre, share a key; 200 sets with unrelated edits share none."""
    r, percent = random.Random(5), 80
    centre = frozenset(range(100))
    sets = {0: centre}
    for i in range(1, 201):
        own = r.sample(range(100), 12)
        sets[i] = centre - set(own) | {1000 * i + k for k in range(16)}
    for family in range(20):
        gone, more = r.sample(range(100), 15), [10 ** 6 + 100 * family + k for k in range(15)]
        for i in range(3):
            sets[201 + 3 * family + i] = centre - set(gone[i:]) | set(more[: 15 - i])
    linked = lambda x, y: 100 * len(sets[x] & sets[y]) >= percent * len(sets[x] | sets[y])
    members = [i for i in sets if i]
    groups = spark.createDataFrame([(7, i, 0) for i in members], "key long, id long, centre long")
    differ = spark.createDataFrame([(i, 0, len(sets[i]), 100, sorted(sets[i] ^ centre)) for i in members],
                                   "id long, centre long, n long, m long, edits array<long>")
    got = jaccard.edit_keys(groups, differ, percent).collect()
    short, long = ({(q.id, q.key) for q in got if q[name]} for name in ("short", "long"))
    keys = {i: ({k for j, k in short if j == i}, {k for j, k in long if j == i}) for i in members}
    wanted = [(x, y) for x in members for y in members if x < y and linked(x, y) and not (linked(x, 0) and linked(y, 0))]
    assert wanted and all(keys[x][0] & keys[y][1] or keys[x][1] & keys[y][0] for x, y in wanted)
    assert not any(linked(i, 0) for i in range(1, 201)) and not any(keys[i][0] for i in range(1, 201))


def test_segments_hold_the_largest_difference():
    for top in range(1, 400):
        for small in range(1, top + 1):
            same = next((c for c in range(small + 1) if 100 * c >= 90 * (small + top - c)), None)
            if same is not None:
                assert small + top - 2 * same < jaccard.segments(top, 90)


def test_contained_items(spark):
    item = " ".join(f"b{i}" for i in range(25))
    bench = spark.createDataFrame([(1, item), (2, None), (3, ""), (4, "two words")], "item_id long, text string")
    near = item.replace("b24", "zz")
    rows = ODD + [(1, "x y " + item.upper() + " z"), (2, near), (3, " ".join(item.split()[:15])), (4, "Two, words")]
    got = {(r.doc_id, r.item_id): r.n_shared for r in decontaminate.contained(table(spark, rows), bench).collect()}
    assert got == {(1, 1): 21, (2, 1): 20, (4, 4): 1}
    kept = decontaminate.without_contaminated(table(spark, rows), bench)
    assert kept.count() == len(ODD) + 1 and kept.columns == ["doc_id", "text"]


def test_items_are_never_missed(spark):
    r = random.Random(5)
    items = [(i, " ".join(f"v{r.randrange(500)}" for _ in range(r.randint(5, 60)))) for i in range(30)]
    docs = []
    for k in range(60):
        words = items[k % 30][1].split()
        cut = r.randrange(len(words))
        docs.append((k, " ".join(["pre"] * 3 + words[: max(1, len(words) - cut // 4)] + ["post"])))
    got = {(x.doc_id, x.item_id) for x in decontaminate.contained(
        table(spark, docs), spark.createDataFrame(items, "item_id long, text string")).collect()}
    def shingles(t):
        w = t.split()
        return {tuple(w[i:i + 5]) for i in range(max(1, len(w) - 4))}
    assert got == {(d, i) for d, t in docs for i, u in items if len(shingles(t) & shingles(u)) >= 0.8 * len(shingles(u)) - 1e-9}


@pytest.mark.parametrize("size", [15, 255])
def test_items_without_their_probes_are_found(spark, size):
    item = [f"p{k}" for k in range(size + 4)]
    windows = [" ".join(item[k:k + 5]) for k in range(size)]
    found = spark.createDataFrame([(w,) for w in windows], "w string")
    order = [q.w for q in found.orderBy(F.xxhash64(F.lit(11), "w")).collect()]
    kept = order[size // 5:]
    doc = " ".join(f"{w} gap{k}" for k, w in enumerate(kept))
    got = decontaminate.contained(table(spark, [(1, doc)]), spark.createDataFrame([(7, " ".join(item))], "item_id long, text string"))
    assert [(q.doc_id, q.item_id, q.n_shared, q.n_item) for q in got.collect()] == [(1, 7, len(kept), size)]


def test_links_of_embeddings(spark):
    r = np.random.default_rng(1)
    base = r.normal(size=(60, 16))
    x = np.concatenate([base, base[:20] + 0.05 * r.normal(size=(20, 16)), np.repeat(base[:1], 150, 0) + 0.03 * r.normal(size=(150, 16)), base[:3]])
    rows = [(i, v.tolist(), int(i % 2 if i < 60 else 0)) for i, v in enumerate(x)]
    rows += [(900, None, 1), (901, [0.0] * 16, 1), (902, [float("nan")] * 16, 0), (903, base[0].tolist(), None), (904, [1.0, None], 0)]
    got = {q.vec_id: (q.n_links, q.component_id, q.kept) for q in embeddings.near_duplicates(
        spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")).collect()}
    good = rows[:len(x)]
    u = x / np.linalg.norm(x, axis=1, keepdims=True)
    near = (u @ u.T >= 0.98) & (np.array([g[2] for g in good])[:, None] == np.array([g[2] for g in good])[None])
    np.fill_diagonal(near, False)
    component = brute.components(range(len(x)), zip(*np.nonzero(near), strict=True))
    want = {i: (int(near[i].sum()), int(component[i]), component[i] == i) for i in range(len(x))}
    assert {i: got[i] for i in want} == want
    assert all(got[i] == (0, i, True) for i in range(900, 905))


@pytest.mark.parametrize("cone", [0.0, 0.9, 0.97])
def test_links_of_clustered_embeddings(spark, cone):
    r = np.random.default_rng(7)
    middle = r.normal(size=(4, 32))
    middle /= np.linalg.norm(middle, axis=1, keepdims=True)
    around = r.normal(size=(2400, 32))
    around /= np.linalg.norm(around, axis=1, keepdims=True)
    x = np.sqrt(cone) * middle[np.arange(2400) % 4] + np.sqrt(1 - cone) * around
    x = np.concatenate([x, x[:200] + 0.19 / np.sqrt(32) * r.normal(size=(200, 32))])
    u = x / np.linalg.norm(x, axis=1, keepdims=True)
    rows = [(i, v.tolist(), 0) for i, v in enumerate(x)] + [(5000, x[0].tolist() + [0.0], 0), (7, x[7].tolist(), 0)]
    got = {q.vec_id: (q.n_links, q.component_id, q.kept) for q in embeddings.near_duplicates(
        spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int"), most_passes=24).collect()}
    near = u @ u.T >= 0.98
    np.fill_diagonal(near, False)
    component = brute.components(range(len(x)), zip(*np.nonzero(near), strict=True))
    extra = near[:, 7].astype(int)
    extra[7] = 1
    want = {i: (int(near[i].sum() + extra[i]), int(component[i]), component[i] == i) for i in range(len(x))}
    assert {i: got[i] for i in want} == want
    assert got[5000] == (0, 5000, True)


def test_no_embeddings(spark):
    empty = spark.createDataFrame([], "vec_id long, embedding array<double>, label int, place int")
    assert embeddings.near_duplicates(empty).collect() == []


def test_suffix_arrays():
    r = random.Random(3)
    for _ in range(300):
        s = [r.randint(1, r.choice([2, 3, 9])) for _ in range(r.randint(0, 60))] + [0]
        order = suffixes.suffix_array(np.array(s), 12)
        assert order.tolist() == sorted(range(len(s)), key=lambda i: s[i:])
        common = suffixes.permuted_prefixes(np.array(s), order)
        for a, b in zip(order[:-1], order[1:], strict=True):
            n = 0
            while s[a + n] == s[b + n]:
                n += 1
            assert common[b] == n


@pytest.mark.parametrize("many", [4096, 2])
def test_repeated_bytes(spark, many, monkeypatch):
    r = random.Random(4)
    def word(n):
        return "".join(r.choice("abcdefgh é") for _ in range(n))
    passages = [word(n) for n in (150, 199, 200, 201, 400, 900)]
    rows = [(i, "".join(r.choice([*passages, word(r.randint(0, 300)), word(60)]) for _ in range(4))) for i in range(60)]
    rows += [(100, "a" * 700), (101, "ab" * 300), (102, "x" * 250 + "ab" * 150), (103, rows[0][1]), (104, None), (105, ""), (106, "z")]
    run = substrings.repeated_spans
    monkeypatch.setattr(substrings, "repeated_spans", lambda d, s: run(d, s, many=many))
    got = {q.doc_id: tuple(q)[1:] for q in substrings.without_repeats(table(spark, rows)).collect()}
    assert got == brute.repeats(rows)


def test_base_spans(spark):
    r = random.Random(2)
    parts = ["1", "2", "5.", "255", ".", "-", " ", "+", "(", ")", "@", "a", "b.c", "x_", "4111111111111111", "é", "\n"]
    rows = ODD + [(i, "".join(r.choice(parts) for _ in range(r.randint(0, 40)))) for i in range(400)] + [(9, "1 " * 20000), (8, "a." * 20000 + "@b.c")]
    got = sorted(str(tuple(q)[:6]) for q in privacy.report(table(spark, rows)).collect())
    want = []
    for i, t in rows:
        spans = brute.base_spans(t)
        want.append(str((i, *[sum(s.startswith(k + ":") for s in spans) for k in brute.KINDS], brute.sha(",".join(spans)))))
    assert got == sorted(want)


def test_disclosing_terms_are_found_near_their_entity_only(spark):
    rows = [(i, f"note {i} ask Zebulon at boss@corp.com about {'bcdfg'[i]}tem and more") for i in range(5)]
    rows += [(10 + i, f"plain text number {i} about more and note") for i in range(40)]
    got = {q.doc_id: q.spans for q in privacy.report(table(spark, rows)).collect()}
    assert all("term:11:18" in got[i] for i in range(5)) and all(got[i] == "" for i in range(10, 50))
    clean = {q.doc_id: q.text for q in privacy.sanitised(table(spark, rows)).collect()}
    assert clean[0] == "note 0 ask [term] at [email] about btem and more" and clean[12] == rows[7][1]


def test_disclosing_terms_of_whole_and_copied_texts(spark):
    far = "plain words that say nothing here " * 20
    rows = [(i, f"no {i} Zebulon {far} ask boss@corp.com or {'bcdfg'[i]}tem") for i in range(5)]
    rows += [(100 + i, rows[0][1]) for i in range(300)]
    rows += [(1000 + i, f"{far} number {i} corp") for i in range(200)]
    got = {q.doc_id: q.spans for q in privacy.report(table(spark, rows)).collect()}
    at = rows[0][1].index("Zebulon")
    for i in [*range(5), *range(100, 400)]:
        assert [x for x in got[i].split(",") if x.startswith("term")] == [f"term:{at}:{at + 7}"]
    assert all(got[1000 + i] == "" for i in range(200))


def test_pages(spark):
    rows = [(i, f"http://h.com/{i}", f"<body><header><h1>Site</h1></header><div class='cookie-note'>c</div><div class=col><h2>T {i}</h2>"
             f"<p>text&nbsp;{i} a &lt; b<br>x<div class=x>Share this</div><p>tail <b>{i}<script>var t='</p>';</script></div>"
             f"<section id=comments><p>no</p></section><form>f</form><footer>z") for i in range(6)]
    rows += [(7, None, None), (8, "http://h.com/8", ""), (9, "x", "<article><p>a<p>b</article><p>c")]
    got = {q.page_id: (q.text, q.n_chars) for q in wrappers.main_texts(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    assert got[2] == ("T 2\ntext 2 a < b x\ntail 2", 25) and got[7] == got[8] == ("", 0) and got[9] == ("a\nb", 3)


def templated(spark, rows):
    return {q.page_id: q.text for q in wrappers.main_texts(
        spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}


def test_templates_of_hosts(spark):
    def page(host, i, article, last="Printed on our own paper"):
        return (f"<div class=top>Daily {host}</div><div>Call us any time</div>" + "".join(f"<p>{a}</p>" for a in article)
                + f"<div>{last}</div>")
    rows = [(i, f"http://one.com/{i}", page("one", i, [f"alpha {i} {k}" for k in range(1 + i % 3)])) for i in range(40)]
    rows += [(100 + i, f"http://two.com/{i}", page("two", i, [f"beta {i}", "a line of some pages" if i % 3 == 0 else f"b {i}"])) for i in range(12)]
    copied = [f"copied {k}" for k in range(3)]
    rows += [(200 + i, f"http://copies.com/{i}", page("copies", i, copied if i < 20 else [f"gamma {i} {k}" for k in range(3)])) for i in range(30)]
    rows += [(300 + i, f"http://few.com/{i}", page("few", i, [f"delta {i}"])) for i in range(3)]
    got = templated(spark, rows + rows[:1])
    assert all(got[i] == "\n".join(f"alpha {i} {k}" for k in range(1 + i % 3)) for i in range(40))
    assert all(got[100 + i] == f"beta {i}\n" + ("a line of some pages" if i % 3 == 0 else f"b {i}") for i in range(12))
    assert all(got[200 + i] == "\n".join(copied) for i in range(20))
    assert all(got[300 + i] == f"Daily few\nCall us any time\ndelta {i}\nPrinted on our own paper" for i in range(3))


def test_names_that_are_no_furniture(spark):
    bodies = ['<div class="layout has-sidebar"><article><p>a</article></div>', '<div id=page class="no-sidebar"><p>a</div>',
              '<article><p class="search-history-text">a<p class="social-impact">b<div class="alert-level">c</div></article>',
              '<article><p>a</p><div class="cookie-notice">x</div><div class="share-buttons">y</div><div id="sidebar-2">z</div></article>',
              "<div>" * 200 + "a" + "</div>" * 200 + "<footer>x</footer>"]
    got = templated(spark, [(i, f"http://h{i}.com", b) for i, b in enumerate(bodies)])
    assert got == {0: "a", 1: "a", 2: "a\nb\nc", 3: "a", 4: "a"}
    assert templated(spark, []) == {}


def test_tree_matching():
    one, two = wrappers.parse("<ul><li>a<li>b<li>c</ul><p>x"), wrappers.parse("<ul><li>b<li>c</ul><div>n</div><p>x")
    assert wrappers.constants(one, two, wrappers.located(one), wrappers.located(two)) == [("#/ul/li", "b"), ("#/ul/li", "c"), ("#/p", "x")]


def test_archives(spark):
    long = "é" * 60
    rows = [(3, "u\n", long), (1, "u", long), (2, None, long), (4, "u", "short"), (5, "u", "short"), (6, "u", None), (None, "u", long), (1, "u", long)]
    got = sorted(str(tuple(q)) for q in warc.round_trip(spark.createDataFrame(rows, "page_id long, url string, html string")).collect())
    want = [(i, len((t or "").encode()), brute.sha(t or ""), "revisit" if t == long and i in (2, 3) else "response",
             1 if t == long and i in (2, 3) else None) for i, _, t in rows]
    assert got == sorted(map(str, want))


def test_broken_archives():
    good = warc.record(1, "u", "<p>x</p>", None, "", "1970-01-01T00:00:00Z")
    import io
    import zlib
    assert warc.parse(next(warc.members(io.BytesIO(good))))["payload"] == b"<p>x</p>"
    with pytest.raises(warc.BadArchive):
        list(warc.members(io.BytesIO(good[:-9])))
    raw = zlib.decompress(good, 31)
    for bad in (raw.replace(b"<p>x", b"<p>y"), raw[:-1], raw.replace(b"WARC/1.1", b"WARC/0.1")):
        with pytest.raises(warc.BadArchive):
            warc.parse(bad)


FOLDER = "/root/testdata/sf0.01"


def test_language_on_held_out_documents(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet").select("doc_id", "text", "lang")
    odd = spark.createDataFrame([(1, None, None), (2, "", "en"), (3, "12 34!", "en")], "doc_id long, text string, lang string")
    found = language.learn_and_identify(docs.union(odd)).withColumn("out", language.held_out())
    rows = found.where("out and lang is not null and lang_pred <> 'und'").collect()
    assert sum(r.lang == r.lang_pred for r in rows) >= 0.97 * len(rows)
    assert found.where("lang_pred = 'und' and score = 0").count() == 3
    none = language.learn_and_identify(odd)
    assert {r.lang_pred for r in none.collect()} == {"und"}


def test_quality_on_held_out_documents(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet").select("doc_id", "text")
    labels = spark.read.parquet(f"{FOLDER}/labels.parquet")
    model = quality.fit(docs, labels)
    rows = quality.score(docs, model).join(labels, "doc_id").where("held_out").collect()
    good = [r.score for r in rows if r.quality == 1]
    bad = [r.score for r in rows if r.quality == 0]
    assert np.mean([g > b for g in good for b in bad]) >= 0.9
    odd = quality.score(table(spark, ODD), model).collect()
    assert len(odd) == len(ODD) and all(0 <= r.score <= 1 for r in odd)
    empty = quality.fit(docs, labels.limit(0))
    assert {r.score for r in quality.score(table(spark, ODD), empty).collect()} == {0.5}


def test_quality_gradient():
    r = np.random.default_rng(0)
    x, first, y = r.normal(size=(7, quality.WIDTH)) * 0.1, np.array([0, 3, 3, 7]), np.array([1.0, 0.0, 0.0])
    size = sum(int(np.prod(s)) for s in quality.shapes(4, 3).values())
    p = r.normal(size=size) * 0.3
    g = quality.gradient(x, first, y, quality.split(p, 4, 3))
    def loss(q):
        s = quality.forward(x, first, quality.split(q, 4, 3))["score"]
        return -np.mean(y * np.log(s) + (1 - y) * np.log(1 - s))
    for k in [*range(0, size, 97), *range(size - 24, size)]:
        step = np.zeros(size)
        step[k] = 1e-5
        assert abs((loss(p + step) - loss(p - step)) / 2e-5 - g[k]) < 1e-6


def test_pipeline_keeps_clean_documents(spark, tmp_path):
    import corpus_pipeline

    rows = [(i, f"document number {i} says hello to everyone in the town of x{i}y and goes home again", "en", "s", 1) for i in range(30)]
    rows += [(100, rows[0][1], "en", "s", 1), (101, None, None, None, None), (102, "12 34", "en", "s", 5)]
    rows += [(103, "read the secret item one two three four five six now mail a@b.cd", "de", "s", 1)]
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(1, "secret item one two three four five six")], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    out = corpus_pipeline.run(spark, str(tmp_path))
    assert sorted(r.doc_id for r in out.collect()) == list(range(30))


def test_pipeline_links_near_copies_by_five_words(spark, tmp_path):
    import corpus_pipeline

    r = random.Random(8)
    rows = []
    for k in range(12):
        words = [f"w{r.randrange(10 ** 6)}" for _ in range(52)]
        inner, last = list(words), list(words)
        inner[20 + k] = "changed"
        last[-2 - k % 3] = "other"
        rows += [(10 * k + i, " ".join(w)) for i, w in enumerate([words, inner, last, words[:26] + last[30:]])]
    sets = {i: brute.shingles(t, 5) for i, t in rows}
    share = {(a, b): len(sets[a] & sets[b]) / len(sets[a] | sets[b]) for a in sets for b in sets if a < b}
    assert sum(0.8 <= s < 0.9 for s in share.values()) >= 12
    component = brute.components(sets, [p for p, s in share.items() if s >= 0.8])
    kept = corpus_pipeline.one_per_group(spark, table(spark, rows), str(tmp_path)).collect()
    assert sorted(q.doc_id for q in kept) == sorted({component[i] for i in sets})
