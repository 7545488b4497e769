"""The stages of the corpus pipeline on small tables, against plain Python."""

import random
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from martlet.llm import line_dedup, quality_rules
from tests.llm.test_operators import classes, ids_of, normal_words, prose, simhash_of, table


def deduped_lines(docs, width, line_words):
    """Texts of `docs` (distinct ids and texts, in order of place) without later copies of runs."""
    seen, want = set(), {}
    for doc in docs:
        lines, gone = (doc[1] or "").split("\n"), set()
        for i in range(len(lines)):
            runs = [tuple(lines[i : i + width])] if i + width <= len(lines) else []
            if len(lines[i].encode().split()) >= line_words:
                runs.append((lines[i],))
            for run in runs:
                if any(x.encode().split() for x in run) and run in seen:
                    gone |= set(range(i, i + len(run)))
            seen |= set(runs)
        want[doc] = None if doc[1] is None else "\n".join(x for i, x in enumerate(lines) if i not in gone)
    return want


@pytest.mark.parametrize("width,line_words", [(1, 4), (2, 1), (2, 4), (3, 4), (2, 30)])
def test_long_single_lines(spark, width, line_words):
    rng = random.Random(8)
    pool = [" ".join(rng.choices(["a", "b", "ü"], k=rng.randint(0, 6))) for _ in range(12)] + ["\ta  b\x0bc \x0cd", "", "x " * 30]
    given = [(i, "\n".join(rng.choices(pool, k=rng.randint(1, 8)))) for i in range(40)] + [(50, None), (51, ""), (None, pool[0]), (52, pool[-1]), (52, pool[-1])]
    h = {t: spark.range(1).select(F.xxhash64(F.lit(t or ""))).first()[0] for t in {t for _, t in given}}
    want = deduped_lines(sorted(set(given), key=lambda d: (d[0] is None, d[0] or 0, h[d[1]])), width, line_words)
    got = line_dedup.dedup_lines(table(spark, given), width, line_words=line_words)
    assert Counter(tuple(r) for r in got.select("record.doc_id", "record.text", "kept_text").collect()) == Counter((*d, want[d]) for d in given)


def test_line_dedup_stage_deletes_later_copies_of_one_long_line(spark):
    rng = random.Random(9)
    passage, frame = prose(rng, 20), prose(rng, 19)
    given = [(1, f"one\n{passage}\ntwo\n{frame}\nthree"), (2, f"four\n{frame}\nfive\n{passage}\nsix"), (3, passage), (4, frame)]
    got = {r.doc_id: (r.text, r.n_chars) for r in corpus_pipeline.line_deduped(spark, table(spark, given), "").collect()}
    want = {1: given[0][1], 2: f"four\n{frame}\nfive\nsix", 3: "", 4: frame}
    assert got == {k: (v, len(v)) for k, v in want.items()}


def test_quality_stage_judges_repeats_that_pass_the_base_rules(spark):
    """Words that occur once, but for copies of runs: what is rejected is rejected by one limit alone."""
    fresh = (f"w{i}" for i in range(10**6))
    words = lambda n: [next(fresh) for _ in range(n)]

    def text(n, *copied):
        """n words, among them two copies of a run of each length, apart from each other."""
        runs = [words(k) for k in copied]
        gap = (n - 2 * sum(copied)) // (2 * len(runs) + 1)
        parts = [words(gap) + run for run in runs + runs]
        out = sum(parts, [])
        return " ".join(out + words(n - len(out)))

    frame = words(9)
    given = {
        1: (text(2000, 80), False),  # 8 % covered, the run 4 %
        2: (text(2000, 60), False),  # a run of 3 % is no fault
        3: (text(3000, 91), False),
        4: (text(300, 10), False),  # neither is one of 10 words
        5: (text(300, 11), False),
        6: (text(2000, *[30] * 4), False),  # 12 % covered by runs of 1.5 %
        7: (text(2000, *[9] * 12), False),  # as much by runs of under 10 words
        8: (text(180, 10), False),  # 11 % covered
        9: (" ".join(frame + words(130) + frame), False),  # a site's line at the top and the bottom
        10: (text(2000, 210), True),
    }
    docs = table(spark, [(i, t) for i, (t, _) in given.items()])
    rated = {r.doc_id: r for r in quality_rules.rate(docs).select("record.doc_id", "measures.*").collect()}
    assert {i: r.base_failed for i, r in rated.items()} == {i: failed for i, (_, failed) in given.items()}
    kept = {r.doc_id: r.text for r in corpus_pipeline.good(spark, docs, "").collect()}
    assert kept == {i: given[i][0] for i in (2, 4, 7, 9)}
    by_share = {i for i, r in rated.items() if not r.base_failed and r.longest_repeat > 10 and 100 * r.longest_repeat > 3 * r.n_words}
    by_cover = {i for i, r in rated.items() if not r.base_failed and 10 * r.n_covered_words > r.n_words}
    assert (by_share - by_cover, by_cover - by_share) == ({1, 3, 5}, {6, 8})


def good_by_hand(text):
    words = (text or "").encode().split()

    def repeated(n):
        seen = Counter(tuple(words[i : i + n]) for i in range(len(words) - n + 1))
        return {k for i in range(len(words) - n + 1) if seen[tuple(words[i : i + n])] > 1 for k in range(i, i + n)}

    longest = max(10, 3 * len(words) // 100) + 1
    return len(words) >= 10 and 100 * len(repeated(5)) <= 20 * len(words) and 10 * len(repeated(10)) <= len(words) and not repeated(longest)


def near_by_hand(docs):
    """Of each group of texts linked by fingerprints at a distance of 2 at most the one with the smallest id."""
    fps = {i: simhash_of(t) for i, t in docs.items()}
    root = classes(sorted(set(fps.values())), lambda a, b: (a ^ b).bit_count() <= 2)
    least = {}
    for i in sorted(docs):
        least.setdefault(root[fps[i]], i)
    return {i: docs[i] for i in least.values()}


def clean_by_hand(docs, items):
    windows = set()
    for item in items:
        words = [w for w in normal_words(item) if w]
        windows |= {tuple(words[i : i + 10]) for i in range(max(1, len(words) - 9))}

    def hit(text):
        words = [w for w in normal_words(text) if w]
        return any(tuple(words[i : i + n]) in windows for n in {len(w) for w in windows} for i in range(len(words) - n + 1))

    return {i: t for i, t in docs.items() if not hit(t)}


def test_stages_in_a_row(spark, tmp_path):
    rng = random.Random(11)
    some = lambda n: " ".join("".join(rng.choices("abcdefghij", k=4)) for _ in range(n))
    base = [some(rng.randint(40, 120)) for _ in range(12)]
    passage, notice, items = some(70), some(25), [some(14), some(10), some(4)]
    docs = dict(enumerate(base))
    docs |= {20: base[3], 21: base[4] + "\n" + base[5], 22: f"{base[6]}\n{notice}\n{some(30)}", 23: f"{some(30)}\n{notice}\n{some(20)}"}
    docs |= {24: f"{some(30)} {items[0]} {some(9)}", 25: f"{some(12)}\n{items[1].upper()}", 26: f"{some(20)} {items[2]}", 27: f"{some(20)} {items[0][:40]}"}
    docs |= {28: f"{passage} {some(1700)} {passage}", 29: some(9), 30: None, 31: "", 32: "same words here " * 20}
    docs |= {33: f"{some(60)}\nby one\nby two\n{some(15)}", 34: f"{some(60)}\nby one\nby two\n{some(15)}", 35: f"{some(50)}\nby one\n{some(15)}"}
    docs |= {40 + i: base[8 + i].replace(" ", "  ") for i in range(3)}  # other lines, equal fingerprints
    docs |= {50: base[0].upper(), 51: f"{items[0]}\n{some(40)}", 52: f"{some(30)}\n{items[0]}"}
    spark.createDataFrame([(i, t, None if t is None else len(t)) for i, t in docs.items()], "doc_id long, text string, n_chars long").repartition(3).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame(list(enumerate(items)), "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    want = [{i: t for i, t in docs.items() if good_by_hand(t)}]
    want.append({d[0]: t for d, t in deduped_lines(sorted(want[0].items()), 2, 20).items()})
    want.append(near_by_hand(want[1]))
    want.append(clean_by_hand(want[2], items))
    assert len(docs) > len(want[0]) == len(want[1]) > len(want[2]) > len(want[3]) and want[0] != want[1]
    held = spark.read.parquet(f"{tmp_path}/documents.parquet")
    for (name, stage), texts in zip(corpus_pipeline.STAGES, want):
        held = stage(spark, held, str(tmp_path))
        rows = held.collect()
        assert len(rows) == len(texts) and {r.doc_id: r.text for r in rows} == texts, name
        assert all(r.n_chars == len(r.text) for r in rows), name
        held = spark.createDataFrame(rows, held.schema)
    pieces = {}
    for r in corpus_pipeline.run(spark, str(tmp_path)).collect():
        pieces.setdefault(r.doc_id, []).append(r)
    assert set(pieces) == set(want[3])
    for i, text in want[3].items():
        ids = np.array([*ids_of("byte_bpe_50k.json", text), 0], dtype="<u4")
        at = 0
        for r in sorted(pieces[i], key=lambda r: r.start):
            part = ids[r.start : r.start + r.length]
            assert (r.start, r.doc_tokens, r.ids_crc32) == (at, len(ids), zlib.crc32(part.tobytes()))
            at += r.length
        assert at == len(ids)
