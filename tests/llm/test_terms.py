"""Collocations, spelling variants and personal data against brute force."""

import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict
from math import log2

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from martlet.llm import collocations, privacy, spelling
from martlet.llm.collocations import MisraGries

DOCS = "doc_id long, lang string, text string, word string, node string, f int, entity string, row string"


def table(spark, rows):
    """Documents with columns whose names the operators use themselves."""
    return spark.createDataFrame([(i, lang, t, "w", "n", 1, "e", "r") for i, lang, t in rows], DOCS)


def lowered(text):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in text)


# -------------------------------------------------------------------- collocations
def brute_collocations(rows, threshold, best, share=100):
    f, n = defaultdict(Counter), Counter()
    for _, lang, text in rows:
        lang = "und" if lang is None else lang
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", lowered(text or "")):
            w = re.findall(r"[^\x20\x09]+", piece)
            n[lang] += len(w)
            f[lang].update(tuple(w[i : i + k]) for k in range(1, 6) for i in range(len(w) - k + 1))
    out = []
    for lang, counts in f.items():
        chosen = {p: a for p, a in counts.items() if len(p) > 1 and a >= threshold}
        inside = {
            q[i:j] for q, a in chosen.items() for i in range(len(q)) for j in range(i + 2, len(q) + 1)
            if j - i < len(q) and 100 * a >= share * counts[q[i:j]]
        }
        scored = []
        for p, a in chosen.items():
            if p not in inside:
                cuts = [(1000 * a * n[lang] // (counts[p[:k]] * counts[p[k:]]), k) for k in range(1, len(p))]
                score, k = min(cuts)
                scored.append((-score, -a, " ".join(p).encode(), counts[p[:k]], counts[p[k:]]))
        for rank, (score, a, p, left, right) in enumerate(sorted(scored)[:best], 1):
            out.append((lang, rank, p.decode(), -a, left, right, n[lang], -score))
    return sorted(out)


@pytest.fixture(scope="module")
def texts():
    rng = random.Random(3)
    words = "new york city The the of wheat, stone; river corn\tfield Öl straße a".split(" ")
    out = []
    for i in range(120):
        text = " ".join(rng.choice(words) for _ in range(rng.randint(5, 60)))
        out.append((i, rng.choice(["en", "de", None]), text + rng.choice(["", ".\nNew York City hall", " a a a a a"])))
    out += [(200, "en", None), (201, None, ""), (202, "xx", " \t .,; \n"), (203, "fr", "Seul"), (None, "en", "new york"), (5, "en", "b " * 4000)]
    return out + out[:7]


def rows_of(df):
    return sorted(tuple(r) for r in df.collect())


@pytest.mark.parametrize("best", [10, None])
def test_collocations(spark, texts, best):
    got = collocations.collocations(table(spark, texts).repartition(3), threshold=12, best=best)
    assert got.columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]
    expected = brute_collocations(texts, 12, best)
    assert rows_of(got) == expected and len(expected) > 20


def test_collocations_of_full_summaries(spark, texts, monkeypatch):
    """Summaries that are a few counters large drop most phrases, and none that is frequent."""
    monkeypatch.setattr(collocations, "SLICE_BYTES", 500)
    monkeypatch.setattr(collocations, "HELD", 64)
    got = collocations.collocations(table(spark, texts).repartition(5), threshold=40, best=None, share=60)
    assert rows_of(got) == brute_collocations(texts, 40, None, share=60)


def test_collocations_when_the_filter_is_full(spark, texts, monkeypatch):
    monkeypatch.setattr(collocations.Filter, "has", lambda self, hashes: np.ones(len(hashes), dtype=bool))
    got = collocations.collocations(table(spark, texts), threshold=12, best=50)
    assert rows_of(got) == brute_collocations(texts, 12, 50)


def test_counts_go_out_once_and_packed(spark, texts, monkeypatch):
    """Counts are not stored beside their shuffle, and the second pass gives a row per hash partition and language, not per phrase."""
    landed = []
    monkeypatch.setattr(collocations, "land", lambda df, label: landed.append(label) or df)
    frequent = collocations.frequent_phrases(table(spark, texts), threshold=12)
    assert len(frequent.collect()) > 20 and landed == []
    words = [(lang, " ".join(p), 7919 * i + (i << 33), 1 + i % 300) for i, (lang, *p) in enumerate((x, y, z) for x in ("en", "und") for y in "abcdé" for z in "tuvwx")]
    columns = dict(zip(("lang", "phrase", "h", "f"), map(list, zip(*words))))
    given = pa.table(columns).set_column(2, "h", pa.array(columns["h"], pa.uint64()))
    packed = collocations._packed_rows(collocations._added_up_rows([given, given]), 3)
    assert packed.num_rows <= 3 * 2
    back = collocations._unpacked_rows(packed)
    assert sorted(zip(*back.to_pydict().values())) == sorted((lang, phrase, 2 * f) for lang, phrase, _, f in words)


@settings(max_examples=60, deadline=None)
@given(st.lists(st.tuples(st.integers(0, (1 << 64) - 1), st.integers(1, 1 << 40)), min_size=1, max_size=50))
def test_packed_counts(rows):
    hashes, counts = np.array([h for h, _ in rows], dtype=np.uint64), np.array([c for _, c in rows], dtype=np.int64)
    packed = collocations._packed(hashes, counts)
    assert len(packed[0]) == 5 * len(rows)
    low, same = collocations._unpacked(*packed)
    assert low.tolist() == [h % (1 << 40) for h, _ in rows] and same.tolist() == [c for _, c in rows]


def test_collocations_of_nothing(spark):
    assert collocations.collocations(table(spark, [])).collect() == []
    assert collocations.collocations(table(spark, [(1, "en", "rare words only")])).collect() == []


@settings(max_examples=60, deadline=None)
@given(st.lists(st.lists(st.tuples(st.integers(0, 40), st.integers(1, 9)), max_size=60), min_size=1, max_size=8), st.integers(2, 30))
def test_no_frequent_item_is_lost(chunks, threshold):
    true = Counter()
    for chunk in chunks:
        for h, c in chunk:
            true[h] += c
    summary = MisraGries(sum(true.values()) // threshold + 1)
    for chunk in chunks:
        summary.add(np.array([h for h, _ in chunk], dtype=np.uint64), np.array([c for _, c in chunk], dtype=np.int64))
        summary.merge()
        assert len(summary.hashes) <= summary.capacity
    found = set(summary.reaching(threshold).tolist())
    assert {h for h, c in true.items() if c >= threshold} <= found
    assert summary.short < threshold


# ------------------------------------------------------------------------ spelling
def brute_words(rows, shortest=5, least=3):
    total = Counter()
    for doc_id, _, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = lowered(run)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            total[run[: h % len(run)] + run[h % len(run) + 1 :] if h % 97 == 0 else run] += 1
    return {w: n for w, n in total.items() if n >= least and len(w) >= shortest}


def one_edit(a, b):
    if len(a) > len(b):
        a, b = b, a
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    return len(b) == len(a) + 1 and any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def brute_variants(words, ratio=2):
    form, out = {}, []
    near = {w: [v for v in words if one_edit(w, v)] for w in words}
    for w, n in words.items():
        best = min(near[w], key=lambda v: (-words[v], v), default=None)
        form[w] = best if best is not None and words[best] >= ratio * n else None
    for w, n in words.items():
        root = w
        while form[root]:
            root = form[root]
        out.append((w, form[w], root, n, len(near[w]), words[form[w]] if form[w] else None))
    return sorted(out, key=str)


def spelled(rng, n):
    base = ["wheat", "wheats", "what's", "colour", "color", "Straße", "garçon", "GARÇON", "aaaaa", "aaaaaaa", "aaaaaa", "abababa", "babab"]
    out = []
    for i in range(n):
        words = []
        for _ in range(rng.randint(1, 40)):
            w = list(rng.choice(base))
            for _ in range(rng.choice([0, 0, 0, 1, 1, 2])):
                at = rng.randrange(len(w))
                w[at : at + rng.randint(0, 1)] = rng.choice(["", "a", "b", "é", "×"])
                w = w or ["x"]
            words.append("".join(w))
        out.append((i, "en", rng.choice([" ", "-", "1", "\n"]).join(words)))
    return out


def test_spelling_variants(spark):
    rows = spelled(random.Random(8), 400)
    rows += [(900, "en", None), (901, "en", ""), (None, "en", "colour colour coluor"), (902, "en", "x" * 3000 + " " + "x" * 3001), (903, "en", "日本語 данные")]
    rows += [(904 + i, "en", "x" * 400 + " " + "x" * 399 + "y " + "y" + "x" * 399) for i in range(4)] + rows[:9]
    expected = brute_variants(brute_words(rows))
    got = spelling.spelling_variants(table(spark, rows).repartition(3))
    assert got.columns == ["word", "form", "root", "n", "n_near", "form_n"]
    assert sorted((tuple(r) for r in got.collect()), key=str) == expected
    assert sum(r[4] for r in expected) > 500 and any(r[1] and r[1] != r[2] for r in expected)


def test_near_words_of_short_words(spark):
    words = ["ab", "abc", "ac", "b" * 9, "b" * 10, "ba", "cab", "caab", "zz", "É" * 5, "É" * 4 + "é"]
    pairs = spelling.near_words(spark.createDataFrame([(w,) for w in words], "word string")).collect()
    assert sorted(map(tuple, pairs)) == sorted((a, b) for a in words for b in words if one_edit(a, b))


def test_arrivals_are_not_stored_level_by_level(spark, monkeypatch):
    """Each level is stored once, as its states; what arrives in it is read from there."""
    labels, land = [], spelling.land
    monkeypatch.setattr(spelling, "land", lambda df, label: labels.append(label) or land(df, label))
    words = ["b" * 9, "b" * 10, "cab", "caab", "É" * 5]
    pairs = spelling.near_words(spark.createDataFrame([(w,) for w in words], "word string").coalesce(1)).collect()
    assert len(pairs) == 4 and labels.count("trie-states") > 2
    assert set(labels) == {"trie-nodes", "trie-kept", "trie-edges", "trie-ends", "trie-states", "near-words"}


def test_near_words_when_nodes_share_a_hash(spark, monkeypatch):
    """Nodes that cannot be told apart give walks too many, which no pair survives."""
    class Coarse:
        def __init__(self, seed=0):
            self.value = seed

        def update(self, data):
            self.value = (self.value * 3 + data[0]) % 61

        def intdigest(self):
            return self.value

    monkeypatch.setattr(spelling.xxhash, "xxh64", Coarse)
    words = sorted(brute_words(spelled(random.Random(2), 25), least=1))[:60]
    pairs = spelling.near_words(spark.createDataFrame([(w,) for w in words], "word string").coalesce(1)).collect()
    assert sorted(map(tuple, pairs)) == sorted((a, b) for a in words for b in words if one_edit(a, b))


def test_spelling_of_nothing(spark):
    assert spelling.spelling_variants(table(spark, [])).collect() == []
    assert spelling.spelling_variants(table(spark, [(1, "en", "once only")])).collect() == []


# ------------------------------------------------------------------------- privacy
PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def valid(kind, value):
    digits = [int(c) for c in value if c.isdigit()]
    if kind == "ip":
        return all(int(p) <= 255 for p in value.split("."))
    if kind == "card":
        total = sum(d if i % 2 == 0 else (2 * d if d < 5 else 2 * d - 9) for i, d in enumerate(reversed(digits)))
        return 13 <= len(digits) <= 19 and total % 10 == 0
    return kind == "email" or 9 <= len(digits) <= 15


def brute_base(text):
    return [(k, *m.span()) for k, p in PATTERNS.items() for m in re.finditer(p, text) if valid(k, m[0])]


@settings(max_examples=400, deadline=None)
@given(st.text(alphabet="a.@_-+ 0123(é)日\n", max_size=60))
def test_base_spans_of_odd_texts(text):
    assert privacy.base_spans(text) == brute_base(text)


def test_base_spans_of_long_runs_take_linear_time():
    for text in ("a" * 300_000, "1" * 300_000, "1." * 150_000, "+1" * 100_000, "a@" * 100_000, "a" * 300_000 + "@b.c"):
        assert [k for k, _, _ in privacy.base_spans(text) if k == "email"] == (["email"] if text.endswith("b.c") else [])


NAMES = "Ann Lee Kim Bo Joe Sue Max Eve".split()


def letters(rng):
    people = [(f"{n.lower()}{k}@mail.example.com", f"{n}{k}son") for k in range(3) for n in NAMES]
    common = "please write to the office about this order and that delivery of corn".split()
    rows = []
    for i in range(300):
        mail, name = rng.choice(people)
        filler = [rng.choice(common) for _ in range(rng.randint(4, 30))]
        at = rng.randrange(len(filler))
        filler[at:at] = [rng.choice([name, name.upper(), "someone"]), mail] if rng.random() < 0.6 else [rng.choice(["4111 1111 1111 1111", "+1 (212) 555-1234", "10.0.0.256", "10.0.0.25"])]
        rows.append((i, "en", " ".join(filler)))
    return rows + [(900, "en", None), (901, "en", ""), (None, "en", "ann0@mail.example.com Ann0son"), (902, "en", "Ann0son alone"), rows[3], rows[3]]


def brute_spans(rows, limits):
    found, ct, df_c = [], defaultdict(set), defaultdict(set)
    df_t = defaultdict(set)
    for row, (_, _, text) in enumerate(rows):
        text = text or ""
        base = brute_base(text)
        words = [m.span() for m in re.finditer(r"[^\W_]+", text)]
        for a, b in words:
            df_t[text[a:b].lower()].add(row)
        words = [(a, b) for a, b in words if b - a >= limits.shortest and not any(a < e and s < b for _, s, e in base)]
        near = []
        for kind, s, e in base:
            who = (kind, re.sub("[^0-9]", "", text[s:e]) if kind in ("card", "phone") else text[s:e].lower())
            df_c[who].add(row)
            before, after = [w for w in words if w[0] < s], [w for w in words if w[0] >= s]
            for a, b in before[-limits.reach :] + after[: limits.reach]:
                near.append((who, text[a:b].lower(), a, b))
                ct[who, text[a:b].lower()].add(row)
        found.append((base, near))
    n, out = len(rows), []
    for (doc_id, _, _), (base, near) in zip(rows, found):
        terms = set()
        for who, term, a, b in near:
            together, worth = len(ct[who, term]), log2(n / len(df_c[who]))
            if together >= limits.support and worth > 0 and log2(n * together / (len(df_c[who]) * len(df_t[term]))) / worth >= limits.generalise - 1e-9:
                terms.add((a, b))
        spans = base + [("term", a, b) for a, b in sorted(terms)]
        text_of = [",".join(f"{k}:{a}:{b}" for k, a, b in x) for x in (base, spans)]
        kinds = Counter(k for k, _, _ in base)
        out.append((doc_id, *(kinds[k] for k in PATTERNS), hashlib.sha256(text_of[0].encode()).hexdigest(), text_of[1]))
    return sorted(out, key=str)


def test_privacy(spark):
    rows = letters(random.Random(4))
    got = privacy.privacy_digest(table(spark, rows).repartition(4))
    assert got.columns == ["doc_id", "n_email", "n_ip", "n_card", "n_phone", "base_sha256", "spans"]
    expected = brute_spans(rows, privacy.Limits())
    assert sorted((tuple(r) for r in got.collect()), key=str) == expected
    assert sum("term" in r[-1] for r in expected) > 50


def test_sanitised(spark):
    rows = letters(random.Random(4))
    got = privacy.sanitised(table(spark, rows))
    assert got.columns == table(spark, rows).columns
    texts = {r.doc_id: r.text for r in got.collect()}
    assert len(rows) == got.count() and texts[900] is None and texts[901] == "" and texts[902] == "Ann0son alone"
    for _, _, text in got.select("doc_id", "lang", "text").collect():
        assert not brute_base(text or "")
    assert texts[None].startswith("<email> ") and "Ann0son" not in texts[None]


def test_sanitised_keeps_terms_that_say_little(spark):
    rows = [(i, "en", f"write to the office of p{i % 5}@x.org about the order number {i}") for i in range(60)]
    for r in privacy.sanitised(table(spark, rows)).collect():
        assert r.text == f"write to the office of <email> about the order number {r.doc_id}"


def test_privacy_of_nothing(spark):
    assert privacy.privacy_digest(table(spark, [])).collect() == []
    assert privacy.sanitised(table(spark, [])).collect() == []
