"""Token ids of whole texts with a public tokenizer file, the tokenizers library doing the encoding.

The pre-tokenizers of both files end a piece wherever white space follows other text, so a
text's ids are the ids of its pieces one after another. Pieces repeat a lot: Arrow finds the
distinct ones of a slice, the library encodes those not met before, and NumPy puts the ids
together. A plain word (Latin letters, at most one full stop or comma after them) is one
pre-token, or two, and goes to the library's BPE model without the pre-tokenizer; any other
piece goes through the whole tokenizer. Texts in which white space does not stand alone are
encoded whole where the file keeps white space (`spaced`). The results are those of
`Tokenizer.encode(text, add_special_tokens=False)`; tests compare them.
"""

from __future__ import annotations

import os
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

# White space next to white space, or at either end: pieces cannot be told apart there.
UNSAFE = r"[\s\x0b\x1c-\x1f\x{85}\p{Z}][ \n]|[ \n]$|^\n[\s\x0b\x1c-\x1f\x{85}\p{Z}]"
PLAIN = r"^\n?[A-Za-zÀ-ÖØ-öø-ÿ]+[.,]?$"


def byte_letters() -> dict[int, str]:
    """Byte-level BPE writes each byte as a printable character: itself, or the next free one from 256 on."""
    printable = {*range(33, 127), *range(161, 173), *range(174, 256)}
    rest = [b for b in range(256) if b not in printable]
    return {b: chr(b) for b in printable} | {b: chr(256 + n) for n, b in enumerate(rest)}


class Encoder:
    """`encode(texts)` gives the ids of every text, flat, with the number of ids of each.

    spaced: the file's tokens keep the white space before a word (byte-level BPE); else it drops
    white space and case, and marks word ends.
    literal: a special token spelled in a text is ordinary text.
    most_cached: pieces remembered per generation; it bounds memory and changes no result.
    """

    def __init__(self, path: str, spaced: bool, literal: bool = False, most_cached: int = 350_000):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer, pre_tokenizers

        self.library = Tokenizer.from_file(path)
        self.library.encode_special_tokens = literal
        self.words = Tokenizer(self.library.model)
        self.words.pre_tokenizer = pre_tokenizers.WhitespaceSplit()
        self.spaced, self.most = spaced, most_cached
        self.letters = byte_letters()
        self.blank = self.letters[32]
        vocabulary = self.library.get_vocab()
        # The one token of a plain word that shows its bounds: the first holds the blank, or the last the end mark.
        self.marks = np.zeros(max(vocabulary.values()) + 1, dtype=bool)
        self.marks[[i for s, i in vocabulary.items() if (s[0] == self.blank if spaced else s.endswith("</w>"))]] = True
        self.tails = np.frombuffer(b"\0" * 4 + self.whole(",") + self.whole("."), dtype="<u4")
        self.new_line = self.whole("\n")
        self.young: dict[str, bytes] = {}
        self.old: dict[str, bytes] = {}

    def whole(self, text: str) -> bytes:
        """Ids of a text by the whole tokenizer, as 32-bit little-endian numbers."""
        return np.array(self.library.encode(text, add_special_tokens=False).ids, dtype="<u4").tobytes()

    def _learn(self, bases: list[str], odd: list[str]) -> None:
        """Encode plain words, which may stand after a new line, and other pieces, and remember them."""
        if len(self.young) + len(bases) + len(odd) > self.most:
            self.old, self.young = self.young, {}
        inner = [b for b in bases if b[0] != "\n"]
        for at in range(0, len(inner), 256):
            some = inner[at : at + 256]
            self.young.update(zip(some, self._plain(some)))
        for b in bases:
            if b[0] == "\n":  # no blank before it, so nothing in its ids shows where it starts
                tokens = self.library.model.tokenize(self._mapped(b[1:]))
                self.young[b] = self.new_line + np.array([t.id for t in tokens], dtype="<u4").tobytes()
        for p in odd:
            self.young[p] = self.whole(p if not self.spaced or p[0] == "\n" else " " + p)

    def _mapped(self, word: str) -> str:
        return word if word.isascii() else word.encode().decode("latin-1").translate(self.letters)

    def _plain(self, bases: list[str]) -> list[bytes]:
        """Ids of plain words, encoded in one call and cut at the marked tokens."""
        if self.spaced:
            text = " ".join(self.blank + self._mapped(b) for b in bases)
        else:
            text = " ".join(map(self._mapped, bases))
        ids = np.array(self.words.encode_batch_fast([text], add_special_tokens=False)[0].ids, dtype="<u4")
        marked = np.flatnonzero(self.marks[ids])
        if len(marked) != len(bases):
            raise ValueError("the tokenizer file marks no word bounds")
        cuts = (np.r_[marked, len(ids)] if self.spaced else np.r_[0, marked + 1]) * 4
        flat, cuts = ids.tobytes(), cuts.tolist()
        return [flat[a:b] for a, b in zip(cuts, cuts[1:])]

    def _ids(self, bases: list[str], odd: list[str]) -> list[bytes]:
        young, old = self.young, self.old
        missing = [[], []]
        for group, found in zip((bases, odd), missing):
            for p in group:
                if p not in young:
                    if p in old:
                        young[p] = old[p]
                    else:
                        found.append(p)
        if missing[0] or missing[1]:
            self._learn(*missing)
        young, old = self.young, self.old
        return [young[p] if p in young else old[p] for group in (bases, odd) for p in group]

    def _pieces(self, pieces: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """ids of distinct pieces one after another, and how many each has. An empty piece has none."""
        plain = pc.match_substring_regex(pieces, PLAIN)
        words = pieces.filter(plain)
        last = pc.utf8_slice_codeunits(words, -1)
        tail = pc.equal(last, ",").to_numpy(zero_copy_only=False) + 2 * pc.equal(last, ".").to_numpy(zero_copy_only=False)
        bases = pc.utf8_rtrim(words, ".,")
        bases = (bases if self.spaced else pc.utf8_lower(bases)).dictionary_encode()
        others = pieces.filter(pc.invert(plain))
        known = self._ids(bases.dictionary.to_pylist(), [p for p in others.to_pylist() if p])
        if len(others) and len(known) < len(bases.dictionary) + len(others):
            known.insert(len(bases.dictionary) + others.to_pylist().index(""), b"")
        sizes = np.fromiter(map(len, known), dtype=np.int64, count=len(known)) >> 2
        store, first = np.frombuffer(b"".join(known), dtype="<u4"), np.cumsum(sizes) - sizes
        source = np.empty(len(pieces), dtype=np.int64)
        is_plain = plain.to_numpy(zero_copy_only=False)
        source[is_plain] = bases.indices.to_numpy()
        source[~is_plain] = len(bases.dictionary) + np.arange(len(others))
        ends_in = np.zeros(len(pieces), dtype=np.int64)
        ends_in[is_plain] = tail
        body = sizes[source]
        counts = body + (ends_in > 0)
        at = np.cumsum(counts) - counts
        ids = np.empty(int(counts.sum()), dtype="<u4")
        ids[ranges(at, body)] = store[ranges(first[source], body)]
        ids[(at + body)[ends_in > 0]] = self.tails[ends_in[ends_in > 0]]
        return ids, counts

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """ids of all texts one after another, and how many each has. A null text has none."""
        texts = pc.fill_null(texts.cast(pa.large_string()), "")
        if self.spaced:
            return self._encode_spaced(texts)
        return self._gather(pc.ascii_split_whitespace(texts), np.zeros(len(texts), dtype=bool))

    def _encode_spaced(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        large = lambda s: pa.scalar(s, pa.large_string())
        led = pc.binary_join_element_wise(large("\n"), texts, large(""))
        alone = np.array(pc.match_substring_regex(led, UNSAFE), dtype=bool)
        empty = np.array(pc.equal(pc.binary_length(texts), 0), dtype=bool)
        alone &= ~empty
        led = pc.if_else(pa.array(alone | empty), large(""), led)
        pieces = pc.split_pattern(pc.replace_substring(led, "\n", " \n"), " ")
        flat, counts = self._gather(pieces, alone | empty, led_by=True)
        if not alone.any():
            return flat, counts
        starts = np.cumsum(counts) - counts
        whole = {i: np.frombuffer(self.whole(texts[i].as_py()), "<u4") for i in np.flatnonzero(alone).tolist()}
        parts = [whole[i] if i in whole else flat[starts[i] : starts[i] + counts[i]] for i in range(len(texts))]
        return np.concatenate(parts), np.array([len(p) for p in parts], dtype=np.int64)

    def _gather(self, lists: pa.Array, blank: np.ndarray, led_by: bool = False) -> tuple[np.ndarray, np.ndarray]:
        """Ids of lists of pieces. led_by: each list starts with an empty piece and the new line put before the text."""
        offsets = np.array(lists.offsets, dtype=np.int64)
        coded = lists.values.slice(offsets[0], offsets[-1] - offsets[0]).dictionary_encode()
        offsets = offsets - offsets[0]
        which = coded.indices.to_numpy()
        store, lengths = self._pieces(coded.dictionary)
        first = np.cumsum(lengths) - lengths
        take = lengths[which]
        skip = first[which]
        if led_by:  # the new line before the text is no part of it
            lead = (offsets[:-1] + 1)[~blank]
            take[lead] -= 1
            skip[lead] += 1
        flat = store[ranges(skip, take)]
        return flat, np.diff(np.r_[0, np.cumsum(take)][offsets])


def ranges(starts: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """start, start + 1, ... of each range, one range after another."""
    before = np.cumsum(counts) - counts
    return np.repeat(starts - before, counts) + np.arange(int(counts.sum()))


_encoders: dict[tuple, Encoder] = {}


def encoder(path: str, spaced: bool, literal: bool = False) -> Encoder:
    """One encoder per Python worker; workers are reused, so pieces stay known from task to task."""
    key = (path, spaced, literal)
    if key not in _encoders:
        _encoders[key] = Encoder(*key)
    return _encoders[key]


def per_text(flat: np.ndarray, counts: np.ndarray) -> Iterator[np.ndarray]:
    at = 0
    for n in counts.tolist():
        yield flat[at : at + n]
        at += n
