"""The text operators against brute force on small tables with nulls, ties, repeats and clashing names."""

import hashlib
import itertools
import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import xxhash
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from martlet.llm import (
    chat_format,
    decontaminate,
    line_dedup,
    packing,
    quality_rules,
    sharding,
    simhash,
    substring_dedup,
    token_counts,
    token_store,
)
from martlet.llm.components import components
from martlet.llm.tokens import Encoder

DOCS = "doc_id long, text string, fp string, rank int, found string, n_chars long"


def table(spark, rows):
    """Documents with columns whose names the operators use themselves."""
    return spark.createDataFrame([(i, t, "x", 1, "y", None if t is None else len(t)) for i, t in rows], DOCS)


def prose(rng, n):
    return " ".join(rng.choice("the of and in to a wheat corn field river stone cloud".split()) for _ in range(n))


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(5)
    base = [prose(rng, rng.randint(30, 200)) for _ in range(25)]
    out = [(i, t) for i, t in enumerate(base)]
    for i in range(25, 45):  # near copies, shared passages and lines
        words = rng.choice(base).split(" ")
        words[rng.randrange(len(words))] = "changed"
        out.append((i, " ".join(words) + "\nlicense line\nall rights reserved\n" + prose(rng, 5)))
    passage = prose(rng, 40)
    out += [(45 + i, f"{prose(rng, 20)} {passage}\n\n\n{passage} Ünï cödé {prose(rng, 9)}") for i in range(6)]
    out += [(60, None), (61, ""), (62, " \n\t "), (63, "one"), (64, "Two words"), (None, base[0]), (None, None), (3, base[4])]
    out += [(65, base[2]), (65, base[2]), (66, "a " * 3000), (67, "\n".join(["same line here"] * 40)), (68, "x#* $$ |<>&%\nx#* $$ |<>&%")]
    return out


# ------------------------------------------------------------------------- simhash
def simhash_of(text):
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    shingles = [b" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))]
    hashes = [xxhash.xxh64_intdigest(s, seed=42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def classes(nodes, linked):
    root = {n: n for n in nodes}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in itertools.combinations(nodes, 2):
        if linked(a, b):
            root[find(a)] = find(b)
    return {n: find(n) for n in nodes}


def test_simhash(spark, rows):
    got = simhash.simhash_components(table(spark, rows)).select(
        "record.doc_id", "record.text", F.col("fp").alias("f"), "component_id"
    )
    fps = {t: simhash_of(t) for _, t in rows}
    root = classes(sorted(set(fps.values())), lambda a, b: (a ^ b).bit_count() <= 2)
    least = defaultdict(list)
    for i, t in rows:
        if i is not None:
            least[root[fps[t]]].append(i)
    want = Counter((i, t, fps[t], min(least[root[fps[t]]])) for i, t in rows)
    assert Counter((r[0], r[1], r[2] % (1 << 64), r[3]) for r in got.collect()) == want
    kept = simhash.simhash_dedup(table(spark, rows)).collect()
    assert len(kept) == len(set(root.values())) and set(kept[0].asDict()) == set(table(spark, rows).columns)
    assert {r.doc_id for r in kept} == {min(v) for v in least.values()}
    none = table(spark, [])
    assert simhash.simhash_components(none).count() == 0 and simhash.simhash_dedup(none).count() == 0


@pytest.mark.parametrize("depth", [0, 3])
def test_trie_walk_finds_all_pairs(depth):
    rng = random.Random(1)
    centres = [rng.getrandbits(64) for _ in range(30)]
    values = {c ^ (1 << rng.randrange(64)) ^ (1 << rng.randrange(64)) for c in centres for _ in range(60)} | {0, (1 << 64) - 1}
    groups = defaultdict(list)
    for v in sorted(values):
        groups[v >> 64 - depth if depth else 0].append(v)
    keys = sorted(groups)
    found = set()
    for p, q in itertools.combinations_with_replacement(keys, 2):
        a, b = (np.array(groups[k], dtype=np.uint64) for k in (p, q))
        for i, j in simhash.walk(a, b, depth, 2, p == q, most=50):
            pairs = list(zip(a[i].tolist(), b[j].tolist()))
            assert not found & set(pairs) and len(set(pairs)) == len(pairs)
            found |= set(pairs)
    assert found == {(a, b) for a, b in itertools.combinations(sorted(values), 2) if (a ^ b).bit_count() <= 2}


def test_links_of_split_subtrees_connect_the_same(spark, monkeypatch):
    rng = random.Random(2)
    centres = [rng.getrandbits(64) for _ in range(10)]
    values = sorted({c ^ (1 << rng.randrange(64)) ^ (1 << rng.randrange(64)) for c in centres for _ in range(40)})
    monkeypatch.setattr(simhash, "_subtree_depth", lambda n: 4)
    signed = np.array(values, dtype=np.uint64).view(np.int64).tolist()
    links = simhash.near_links(spark.createDataFrame([(v,) for v in signed], "fp long"), 2, per_chunk=7)
    got = {r.node: r.root for r in components(links).collect()}
    root = classes(values, lambda a, b: (a ^ b).bit_count() <= 2)
    pairs = dict(zip(signed, values))
    members = defaultdict(set)
    for s in signed:
        members[got.get(s, s)].add(root[pairs[s]])
    assert all(len(m) == 1 for m in members.values()) and len(members) == len(set(root.values()))


def test_components_of_chain_star_and_nothing(spark):
    chain = [(i, i + 1) for i in range(40)]
    star = [(100, 100 + i) for i in range(1, 60)]
    got = {r.node: r.root for r in components(spark.createDataFrame(chain + star + [(7, 7)], "a long, b long")).collect()}
    assert got == {i: 0 for i in range(41)} | {100 + i: 100 for i in range(60)}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


# ------------------------------------------------------------------------- quality
def longest_by_hand(words):
    return [
        max(
            (next((k for k in range(len(words)) if max(i, j) + k >= len(words) or words[i + k] != words[j + k]), 0) for j in range(len(words)) if j != i),
            default=0,
        )
        for i in range(len(words))
    ]


def test_suffix_array_finds_longest_repeats():
    rng = random.Random(3)
    texts = [[rng.randrange(3) for _ in range(rng.randint(0, 40))] for _ in range(40)] + [[1] * 30, [], [2], [1, 2] * 9]
    flat = np.array([w for t in texts for w in t])
    owner = np.repeat(np.arange(len(texts)), [len(t) for t in texts])
    got = quality_rules.longest_repeats(flat, owner)
    assert got.tolist() == [n for t in texts for n in longest_by_hand(t)]


def test_quality(spark, rows):
    got = {(r.doc_id, r.text): r for r in quality_rules.rate(table(spark, rows)).select("record.*", "measures.*").collect()}
    assert len(got) == len(set(rows))
    for (_, text), r in got.items():
        words = (text or "").encode().split()
        hit = set()
        seen = Counter(tuple(words[i : i + 5]) for i in range(len(words) - 4))
        for i in range(len(words) - 4):
            if seen[tuple(words[i : i + 5])] > 1:
                hit |= set(range(i, i + 5))
        lines = [x for x in (text or "").split("\n") if x.encode().split()]
        assert (r.n_words, r.n_repeat_words, r.n_dup_lines) == (len(words), len(hit), len(lines) - len(set(lines)))
        assert r.word_chars == sum(len(w.decode()) for w in words) and r.n_symbols == sum(map((text or "").count, "#*$%&|<>"))
        assert r.longest_repeat == (max(longest_by_hand(words), default=0) if len(words) < 300 else r.longest_repeat)
        assert r.base_failed == (len(words) < 10 or 100 * len(hit) > 20 * len(words)) and not (r.base_failed and r.kept)
    kept = quality_rules.keep_good(table(spark, rows))
    assert kept.columns == table(spark, rows).columns and kept.count() == sum(got[r].kept for r in rows)
    assert quality_rules.rate(table(spark, [])).count() == 0


# ---------------------------------------------------------------------------- tokens
ODD_TEXTS = [
    "a", "foo", "Bar's", "b,", "x..", "é", "ñandú", "日本", " ", "  ", "\n", "\n\n", "\t", " ", "　", "12", "3.5",
    "<|endoftext|>", "<|startoftext|>", ".", "'ll", "\x1c", "\x85", "Σας", "é", "🎉", "\r\n", "ﬁ", "İ", "Ünder.", "ÿ",
]


@pytest.mark.parametrize("file, spaced", [("word_bpe_49k.json", False), ("byte_bpe_50k.json", True)])
def test_encoder_equals_the_library(file, spaced):
    rng = random.Random(4)
    texts = ["".join(rng.choice(ODD_TEXTS) + rng.choice(["", " ", "\n"]) for _ in range(rng.randint(0, 14))) for _ in range(1500)]
    texts += ["", None, " ", "\n", " a", "a ", "\na", "word " * 50 + "end"]
    plain, encoder = Tokenizer.from_file(public_tokenizers.path(file)), Encoder(public_tokenizers.path(file), spaced, most_cached=300)
    for at in range(0, len(texts), 100):
        flat, counts = encoder.encode(pa.array(texts[at : at + 100], pa.string()))
        want = [plain.encode(t or "", add_special_tokens=False).ids for t in texts[at : at + 100]]
        assert counts.tolist() == [len(w) for w in want] and flat.tolist() == [i for w in want for i in w]


def test_codes_give_any_token():
    rng = np.random.default_rng(6)
    for n in (0, 1, 511, 512, 513, 5000):
        ids = rng.integers(0, 1 << rng.integers(1, 25, size=n).astype(np.uint64)).astype(np.uint32) if n else np.zeros(0, np.uint32)
        codes = token_store.Codes.from_bytes(token_store.Codes.of(ids).to_bytes())
        assert codes.run(0, n).tolist() == ids.tolist()
        assert [codes.token(i) for i in range(0, n, 7)] == ids[::7].tolist()
        for a, b in rng.integers(0, n + 1, size=(20, 2)):
            assert codes.run(min(a, b), max(a, b)).tolist() == ids[min(a, b) : max(a, b)].tolist()


def ids_of(file, text):
    return Tokenizer.from_file(public_tokenizers.path(file)).encode(text or "", add_special_tokens=False).ids


def crc(ids):
    return zlib.crc32(np.array(ids, dtype="<u4").tobytes())


@pytest.mark.parametrize("segment", [1 << 20, 150])
def test_token_store(spark, rows, segment):
    path = token_store.write_tokens(
        table(spark, rows), public_tokenizers.path("word_bpe_49k.json"), spaced=False, end_id=2, segment_tokens=segment
    )
    got = sorted(token_store.read_tokens(spark, path).collect(), key=lambda r: r.start)
    at = 0
    for r in got:  # gapless, in id order, null first
        assert r.start == at
        at += r.n_tokens
    names = [-1 if r.doc_id is None else r.doc_id for r in got]
    assert names == sorted(names)
    want = Counter((i, len(x := [*ids_of("word_bpe_49k.json", t), 2]), crc(x)) for i, t in rows)
    assert Counter((r.doc_id, r.n_tokens, r.ids_crc32) for r in got) == want
    empty = token_store.write_tokens(table(spark, []), public_tokenizers.path("word_bpe_49k.json"), spaced=False, end_id=2)
    assert token_store.read_tokens(spark, empty).count() == 0


def test_token_counts(spark, rows):
    got = token_counts.count_tokens(table(spark, rows).repartition(3), public_tokenizers.path("byte_bpe_50k.json"), True, 50256)
    literal = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    literal.encode_special_tokens = True
    want = Counter((i, len(literal.encode(t or "", add_special_tokens=False).ids)) for i, t in rows)
    assert Counter((r.doc_id, r.n_tokens) for r in got.collect()) == want


@pytest.mark.parametrize("size", [1, 3, 64])
def test_separators_are_stitched_over_blocks(spark, size):
    rng = random.Random(7)
    files, want = [], []
    for f in range(4):
        ids = [rng.choice([9, 1, 2, 3]) if f else 1 for _ in range(rng.randint(1, 60))]
        place = start = 0
        for at, i in enumerate(ids):
            if i == 9:
                want.append((f, place, start, at - start, True))
                place, start = place + 1, at + 1
        if start < len(ids):
            want.append((f, place, start, len(ids) - start, False))
        blocks = [ids[a : a + size] for a in range(0, len(ids), size)] + [[]]
        files += [(f, b, bytearray(np.array(x, dtype="<u2").tobytes())) for b, x in enumerate(blocks)]
    got = token_counts.scan_separators(spark.createDataFrame(files, "file long, block int, ids binary").repartition(5), 9)
    assert sorted(map(tuple, got.collect())) == sorted(want)


# --------------------------------------------------------------------------- packing
def test_packing(spark, rows):
    got = packing.pack(table(spark, rows), public_tokenizers.path("byte_bpe_50k.json"), length=64, hold=300).collect()
    pieces, total = [], 0
    for r in got:
        ids = np.frombuffer(bytes(r.ids), dtype="<u4")
        assert 0 < len(ids) <= 64 and [p.offset for p in r.pieces] == np.cumsum([0, *[p.length for p in r.pieces]])[:-1].tolist()
        assert sum(p.length for p in r.pieces) == len(ids)
        total += len(ids)
        pieces += [(p.doc_id, p.start, ids[p.offset : p.offset + p.length].tolist(), p.doc_tokens) for p in r.pieces]
    assert len({r.sequence_id for r in got}) == len(got) and sum(64 - len(r.ids) // 4 for r in got) < 0.1 * total
    wholes = Counter((i, tuple([*ids_of("byte_bpe_50k.json", t), 0])) for i, t in rows)
    for (doc_id, ids), n in wholes.items():
        mine = Counter((start, tuple(part)) for d, start, part, size in pieces if d == doc_id and size == len(ids) and tuple(ids[start : start + len(part)]) == tuple(part))
        assert all(any(s <= k < s + len(p) for s, p in mine) for k in range(len(ids)))
    assert total == sum(len(ids) * n for (_, ids), n in wholes.items())


def test_cuts_are_the_best():
    rng = random.Random(8)
    for _ in range(60):
        places = np.array(sorted({0, 30, *rng.sample(range(1, 30), 12)}))
        if np.diff(places).max() > 10:
            continue
        penalties = np.array([0.0, *[rng.choice([0, 2, 5]) for _ in places[2:]], 0.0])
        cost = dict(zip(places.tolist(), penalties))

        def total(cuts):
            return sum(10 - (b - a) + cost[b] for a, b in zip(cuts, cuts[1:]))

        inner = places[1:-1].tolist()
        every = ([0, *c, 30] for k in range(len(inner) + 1) for c in itertools.combinations(inner, k))
        best = min(total(c) for c in every if max(b - a for a, b in zip(c, c[1:])) <= 10)
        assert total(packing.best_cuts(places, penalties, 10).tolist()) == best


def test_sentences_are_cut_inside_only_if_longer_than_a_sequence():
    rng = np.random.default_rng(3)
    for length in (8, 64, 300):
        ids = rng.choice(40, size=6000)
        ids[1000:1700] = 1
        ends_sentence = np.arange(40) == 7
        doc_ends = np.sort(rng.choice(np.arange(1, 6001), size=20, replace=False))
        places, penalties = packing.candidate_cuts(ids, doc_ends, ends_sentence, length, 2.0, 8.0)
        whole = np.unique(np.r_[0, doc_ends, np.flatnonzero(ids == 7) + 1, 6000])
        assert set(whole) <= set(places.tolist()) and np.diff(places).max() <= length
        for place in set(places.tolist()) - set(whole.tolist()):
            k = np.searchsorted(whole, place)
            assert whole[k] - whole[k - 1] > length
        assert (penalties[np.isin(places, doc_ends)] == 0).all() and set(penalties) <= {0.0, 2.0, 8.0}


# ------------------------------------------------------------------------ line dedup
@pytest.mark.parametrize("width", [1, 2, 3, 5])
def test_line_dedup(spark, rows, width):
    more = [(100 + i, "\n".join(random.Random(i // 2).choices("abcd ", k=30))) for i in range(8)]
    given = rows + more
    got = line_dedup.dedup_lines(table(spark, given), min_lines=width).select("record.doc_id", "record.text", "kept_text")
    h = {t: spark.range(1).select(F.xxhash64(F.lit(t or ""))).first()[0] for t in {t for _, t in given}}
    docs = sorted(set(given), key=lambda d: (d[0] is None, d[0] or 0, h[d[1]]))
    seen, want = set(), {}
    for doc in docs:
        lines, gone = (doc[1] or "").split("\n"), set()
        for i in range(len(lines) - width + 1):
            window = tuple(lines[i : i + width])
            if any(x.encode().split() for x in window) and window in seen:
                gone |= set(range(i, i + width))
            seen.add(window)
        want[doc] = None if doc[1] is None else "\n".join(x for i, x in enumerate(lines) if i not in gone)
    found = got.collect()
    assert Counter((r[0], r[1]) for r in found) == Counter(given)
    for r in found:
        twins = [want[d] for d in docs if d[0] == r[0] and (d[1] or "") == (r[1] or "")]
        assert r[2] in twins
    cleaned = line_dedup.without_repeats(table(spark, given), width)
    assert cleaned.columns == table(spark, given).columns
    assert all(r.n_chars == (None if r.text is None else len(r.text)) for r in cleaned.collect())
    assert line_dedup.dedup_lines(table(spark, []), width).count() == 0


# ------------------------------------------------------------------------------ chat
def test_chat_round_trip(spark):
    rng = random.Random(9)
    bits = [*chat_format.CONTROL, "\\", "\n", "<", "|im", "hi", "é🎉", "user", ">", "\\\\", "[", "s>"]
    rows = [(c, t, rng.choice(["user", "assistant", "system", "a\nb", "<s>", "x\\"]), "".join(rng.choices(bits, k=rng.randint(0, 8)))) for c in range(40) for t in range(5)]
    rows += [(50, 0, None, None), (50, 0, "assistant", "tie"), (50, 0, "assistant", "tie"), (None, 1, "assistant", "no id"), (51, None, "user", "")]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").withColumn("t", F.lit(1)).withColumn("rendered", F.lit(2))
    out = chat_format.format_conversations(df)
    read = out.select("conv_id", "formatted", "loss_spans", chat_format.parse_conversation(F.col("formatted")).alias("turns")).collect()
    want = defaultdict(list)
    for c, t, r, x in sorted(rows, key=lambda r: (r[1] is not None, r[1] or 0, r[2] or "", r[3] or "")):
        want[c].append((r or "", x or ""))
    assert {r.conv_id: [tuple(t) for t in r.turns] for r in read} == dict(want)
    for r in read:
        inside = chat_format.START, chat_format.END
        assert all(c not in r.formatted for c in chat_format.CONTROL if c not in inside)
        assert r.formatted.count(chat_format.END) == len(r.turns)
        spans = [r.formatted[s.start : s.start + s.length] for s in r.loss_spans]
        unescaped = [spark_unescape(x) for x in spans]
        assert unescaped == [x for role, x in want[r.conv_id] if role == "assistant"]
    none = df.limit(0)
    assert chat_format.format_conversations(none).count() == 0


def spark_unescape(text):
    out, it = "", iter(text)
    for c in it:
        out += next(it, "\\") if c == "\\" else c
    return out


def test_chat_digest(spark):
    made = chat_format.marked_conversation(spark)
    row = chat_format.chat_digest(made).first()
    said = "</s>[INST] ok [/INST]"
    assert row.n_turns == 2 and row.loss_chars == len(said) and row.loss_sha256 == hashlib.sha256(said.encode()).hexdigest()
    assert row.turns_sha256 == hashlib.sha256(f"user\n{said}\nassistant\n{said}\n".encode()).hexdigest()


# -------------------------------------------------------------------- decontamination
def normal_words(text):
    return "".join(c.lower() if c.isascii() and c.isalnum() else c if not c.isascii() else " " for c in text or "").split(" ")


@pytest.mark.parametrize("block", [1 << 20, 10])
def test_decontamination(spark, rows, block):
    rng = random.Random(10)
    items = [(1, "Wheat, the river"), (2, rows[3][1]), (2, rows[3][1]), (None, prose(rng, 12)), (4, ""), (5, None), (6, "cloud!"), (17, rows[7][1].upper())]
    items += [(30 + i, " ".join(rows[10 + i][1].split()[4:20])) for i in range(5)]
    bench = spark.createDataFrame(items, "item_id long, text string")
    got = decontaminate.decontaminate(table(spark, rows), bench, block_bytes=block).select("record.doc_id", "record.text", "found.*")
    windows = defaultdict(set)
    for item, text in items:
        words = [w for w in normal_words(text) if w]
        for i in range(max(1, len(words) - 9) if words else 0):
            windows[tuple(words[i : i + 10])].add("" if item is None else str(item))
    sizes = {len(w) for w in windows}
    found = got.collect()
    assert Counter((r.doc_id, r.text) for r in found) == Counter(rows)
    for r in found:
        words, hit, names = [w for w in normal_words(r.text) if w], set(), set()
        for n in sizes:
            for i in range(len(words) - n + 1):
                if (w := tuple(words[i : i + n])) in windows:
                    hit |= set(range(i, i + n))
                    names |= windows[w]
        assert r.n_words == len(words) and r.item_ids == sorted(names)
        assert {k for a, b in zip(r.starts, r.ends) for k in range(a, b)} == hit
    kept = decontaminate.keep_clean(table(spark, rows), bench)
    assert kept.count() == sum(not r.starts for r in found) and kept.columns == table(spark, rows).columns
    assert decontaminate.decontaminate(table(spark, rows), bench.limit(0)).filter(F.size("found.starts") > 0).count() == 0
    assert decontaminate.decontaminate(table(spark, []), bench).count() == 0


def test_wu_manber_finds_every_occurrence():
    rng = random.Random(11)
    text = "".join(rng.choices("ab ", k=20000)).encode()
    patterns = ["".join(rng.choices("ab ", k=k)).encode() for k in (1, 2, 3, 5, 8, 13, 20, 40) for _ in range(6)] + [text[4000:4200], text[8190:8300]]
    matcher = decontaminate.WuManber(patterns)
    want = {(at, i) for i, p in enumerate(matcher.patterns) for at in range(len(text)) if text.startswith(p, at)}
    got = list(matcher.search(text))
    assert set(got) == want and len(got) == len(want)


# -------------------------------------------------------------------- substring dedup
@pytest.mark.parametrize("size", [1, 2, 5, 8, 9, 13])
def test_leftmost_least_of_windows(size):
    rng = random.Random(size)
    for n in (size, size + 1, 60):
        values = [rng.randrange(4) for _ in range(n)]
        least, place = substring_dedup.leftmost_least(np.array(values, dtype=np.uint64), size)
        at = [min(range(i, i + size), key=lambda k: (values[k], k)) for i in range(n - size + 1)]
        assert place.tolist() == at and least.tolist() == [values[k] for k in at]


@pytest.mark.parametrize("hot", [10_000, 2])
def test_substring_dedup(spark, rows, hot):
    got = substring_dedup.dedup_substrings(table(spark, rows).repartition(3), hot=hot).collect()
    first = {}
    order = lambda i: (i is None, i or 0)
    for i, t in rows:
        words = (t or "").encode().split()
        for k in range(len(words) - 12):
            w = tuple(words[k : k + 13])
            first[w] = min(first.get(w, order(i)), order(i))
    want = Counter()
    for i, t in rows:
        words, gone = (t or "").encode().split(), set()
        for k in range(len(words) - 12):
            if first[tuple(words[k : k + 13])] < order(i):
                gone |= set(range(k, k + 13))
        want[i, len(words), len(gone), b" ".join(w for k, w in enumerate(words) if k not in gone).decode()] += 1
    assert Counter((r.id, r.n_words, r.n_removed, r.kept_text) for r in got) == want
    assert substring_dedup.dedup_substrings(table(spark, [])).count() == 0


# --------------------------------------------------------------------------- sharding
def test_sharding(spark, rows):
    docs = table(spark, rows + [(9, "hot")] * 400)
    written = sharding.write_shards(docs, shards=4, seed=1, bucket_bytes=500)
    got = sharding.with_slots(written, written).select("record.*", "shard", "slot", "grown_shard").collect()
    assert Counter((r.doc_id, r.text) for r in got) == Counter([*rows, *[(9, "hot")] * 400])
    by_shard, by_id = defaultdict(list), defaultdict(set)
    for r in got:
        by_shard[r.shard].append(r.slot)
        by_id[r.doc_id].add((r.shard, r.grown_shard))
        assert r.grown_shard in (r.shard, 4)
    assert all(sorted(s) == list(range(len(s))) for s in by_shard.values()) and all(len(s) == 1 for s in by_id.values())
    again = sharding.write_shards(docs, shards=5, seed=1).select("record.doc_id", "shard").collect()
    assert all(by_id[r.doc_id] == {(s, r.shard) for s, _ in by_id[r.doc_id]} for r in again)
    assert sharding.write_shards(table(spark, [])).count() == 0
