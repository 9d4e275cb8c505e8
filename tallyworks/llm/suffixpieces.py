"""SentencePiece encoding and decoding by suffix-array matching.

The new words of a batch are laid end to end and their suffixes sorted. Every piece
of the vocabulary is then a range of suffixes, found by binary search, and each suffix in it an
edge over the text. Edges are taken by position and relaxed: at
each place the last piece of the encoding up to there is the one edge that the
merge order lets stand behind what was before it. That gives exactly the merges' result,
as an encoding by merges is right if every two neighbours in it are.
"""

from __future__ import annotations

import gc
import math
import re
import zlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyworks.llm.repetition import window_ranks
from tallyworks.llm.words import slices

SPACE = "▁"
LETTER = r"[^\W\d_]"
PUNCTUATION = ".,;:!?*#$%&|"


def unit_pattern(pieces: Iterable[str]) -> re.Pattern:
    """Cuts a text where no piece reaches across: before spaces, around line breaks, and between a letter and punctuation."""
    inside = [(a, b) for p in pieces for a, b in zip(p, p[1:])]
    if any(b == SPACE != a or "\n" in (a, b) for a, b in inside):
        raise ValueError("a piece reaches across words")
    apart = re.escape("".join(c for c in PUNCTUATION if not any(b == c and re.match(LETTER, a) for a, b in inside)))
    if not apart:
        return re.compile(rf"{SPACE}*[^{SPACE}\n]+|\n|{SPACE}+")
    more = rf"(?:[^{SPACE}\n{apart}]|(?<!{LETTER})[{apart}])"
    return re.compile(rf"{SPACE}*{more}+|[{apart}]{more}*|\n|{SPACE}+")


WORDS_KEPT = 1_000_000
BYTES_AT_ONCE = 4_000_000


class PieceVocabulary:
    """The pieces of a merge model, by id, with the characters they are made of."""

    def __init__(self, path: str):
        import sentencepiece

        self.model = sentencepiece.SentencePieceProcessor(model_file=path)
        size = self.model.vocab_size()
        special = [self.model.is_control(i) or self.model.is_unknown(i) or self.model.is_byte(i) or self.model.is_unused(i) for i in range(size)]
        self.pieces = [self.model.id_to_piece(i) for i in range(size)]
        self.ids = np.array([i for i in range(size) if not special[i]])
        self.rank = {self.pieces[i]: (-self.model.get_score(i), i) for i in self.ids.tolist()}
        self.byte = {int(self.pieces[i][3:5], 16): i for i in range(size) if self.model.is_byte(i)}
        self.units = unit_pattern(self.rank)
        letters = sorted({c for p in self.rank for c in p})
        self.code = {c: i + 1 for i, c in enumerate(letters)}  # 0 stands between words
        self.other = len(letters) + 1
        self.codes = np.full(0x110000, self.other, np.int32)
        self.codes[[ord(c) for c in letters]] = np.arange(1, len(letters) + 1)
        self.longest = max(map(len, self.rank))
        self.bytes_of = [p.replace(SPACE, " ").encode("utf-8") for p in self.pieces]
        for value, i in self.byte.items():
            self.bytes_of[i] = bytes([value])
        self.flat = np.frombuffer(b"".join(self.bytes_of), np.uint8)
        self.flat_sizes = np.array(list(map(len, self.bytes_of)), np.int64)
        self.flat_starts = np.cumsum(self.flat_sizes) - self.flat_sizes
        self.chars = np.zeros((len(self.ids), self.longest), np.int32)
        for row, i in enumerate(self.ids.tolist()):
            self.chars[row, : len(self.pieces[i])] = [self.code[c] for c in self.pieces[i]]
        self.lengths = np.array([len(self.pieces[i]) for i in self.ids.tolist()])
        self.histories = [self.history(p) for p in self.pieces]
        self.made = np.array([h[0] == [p] for h, p in zip(self.histories, self.pieces)])  # whether merges make a piece at all
        self.known_pairs = np.empty(0, np.int64)
        self.known_valid = np.empty(0, bool)

    def history(self, text: str) -> tuple[list[str], list[float], list[str], list[str]]:
        """What the merges make of a short text: again and again the best adjacent pair, from the left.

        Returns the last parts; the rank of each merge, with an endless one behind; and the first and the last part before each.
        """
        parts, ranks, firsts, lasts = list(text), [], [], []
        while True:
            firsts.append(parts[0])
            lasts.append(parts[-1])
            best = min(((self.rank[a + b][0], at) for at, (a, b) in enumerate(zip(parts, parts[1:])) if a + b in self.rank), default=None)
            if best is None:
                return parts, [*ranks, math.inf], firsts, lasts
            rank, at = best
            ranks.append(rank)
            parts[at : at + 2] = [parts[at] + parts[at + 1]]

    def stay_apart(self, one: int, two: int) -> bool:
        """Whether no merge joins parts of both pieces, while each is merged by itself."""
        _, left_ranks, _, lasts = self.histories[one]
        _, right_ranks, firsts, _ = self.histories[two]
        i = j = 0
        rank = self.rank
        while True:
            joined = rank.get(lasts[i] + firsts[j])
            left, right = left_ranks[i], right_ranks[j]
            if joined is not None and joined[0] < left and joined[0] <= right:
                return False
            if left == right == math.inf:
                return True
            if left <= right:
                i += 1
            else:
                j += 1

    def may_follow(self, before: np.ndarray, piece: np.ndarray) -> np.ndarray:
        """Whether the merges leave each pair of pieces as it is. Pairs are worked out once."""
        keys = before.astype(np.int64) * len(self.pieces) + piece
        asked, place = np.unique(keys, return_inverse=True)
        at = np.searchsorted(self.known_pairs, asked)
        known = at < len(self.known_pairs)
        known[known] = self.known_pairs[at[known]] == asked[known]
        new = asked[~known]
        if len(new):
            valid = np.empty(len(new), bool)
            for i, key in enumerate(new.tolist()):
                valid[i] = self.stay_apart(*divmod(key, len(self.pieces)))
            places = at[~known]
            self.known_pairs, self.known_valid = np.insert(self.known_pairs, places, new), np.insert(self.known_valid, places, valid)
            at = np.searchsorted(self.known_pairs, asked)
        return self.known_valid[at][place]

    def ranges(self, text: np.ndarray, suffixes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """For each piece the range of sorted suffixes that begin with it."""
        n = len(suffixes)
        low, high = np.zeros(len(self.ids), np.int64), np.full(len(self.ids), n)
        padded = np.append(text, np.zeros(self.longest, text.dtype))
        for depth in range(self.longest):
            rows = np.flatnonzero((self.lengths > depth) & (low < high))
            want = self.chars[rows, depth]
            ends = []
            for right in (False, True):
                a, b = low[rows].copy(), high[rows].copy()
                while True:
                    open_rows = a < b
                    if not open_rows.any():
                        break
                    middle = (a + b) // 2
                    found = padded[suffixes[np.minimum(middle, n - 1)] + depth]
                    less = (found <= want) if right else (found < want)
                    a = np.where(open_rows & less, middle + 1, a)
                    b = np.where(open_rows & ~less, middle, b)
                ends.append(a)
            low[rows], high[rows] = ends
        return low, high

    def encode_words(self, words: list[str]) -> list[bytes]:
        """The ids of each word, as little-endian 32-bit numbers."""
        sizes = np.array([len(w) for w in words])
        starts = np.cumsum(sizes + 1) - sizes - 1
        total = int(sizes.sum() + len(words))
        text = self.codes[np.frombuffer(("\0".join(words) + "\0").encode("utf-32-le"), np.uint32)]
        text[starts + sizes] = 0  # a zero character in a word is just unknown
        used = np.bincount(text, minlength=self.other + 1) > 0
        dense = (np.cumsum(used) - 1)[text]  # keeps the order
        suffixes, _ = window_ranks(dense, self.longest)
        low, high = self.ranges(text, suffixes)
        found = np.flatnonzero(low < high)
        counts = (high - low)[found]
        begin = suffixes[np.repeat(low[found], counts) + np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts, counts)]
        row = np.repeat(found, counts)
        piece, end = self.ids[row], begin + self.lengths[row]
        # A character that is in no piece is an edge of its own, number -1.
        lone = np.flatnonzero(text == self.other)
        begin, end, piece = np.append(begin, lone), np.append(end, lone + 1), np.append(piece, np.full(len(lone), -1))
        # By the place of their end inside the word, so that all words are relaxed at once.
        word = np.searchsorted(starts, begin, side="right") - 1
        inside = end - starts[word]
        order = np.argsort(inside.astype(np.uint16) if len(inside) and inside.max() < 1 << 16 else inside, kind="stable")
        begin, end, piece, inside = begin[order], end[order], piece[order], inside[order]
        made = self.made
        last = np.full(total + 1, -2, np.int64)  # the last piece up to a place; -2: none yet
        back = np.zeros(total + 1, np.int64)
        bounds = np.searchsorted(inside, np.arange(1, int(sizes.max(initial=0)) + 2))
        at_start = np.zeros(total + 1, bool)
        at_start[starts] = True
        for a, b in zip(bounds, bounds[1:]):
            s, e, p = begin[a:b], end[a:b], piece[a:b]
            before = last[s]
            first = at_start[s] | (before == -1)
            fits = (first & ((p == -1) | made[p])) | ((p == -1) & (before >= 0))
            pairs = np.flatnonzero(~first & (p >= 0) & (before >= 0))
            fits[pairs] = self.may_follow(before[pairs], p[pairs])
            last[e[fits]], back[e[fits]] = p[fits], s[fits]
        # Back from the ends, in all words at once; a round gives each open word one piece more.
        at, live, rounds = starts + sizes, np.arange(len(words)), []
        while len(live):
            place = at[live]
            rounds.append((live, last[place]))
            at[live] = back[place]
            live = live[at[live] > starts[live]]
        of = np.concatenate([w for w, _ in rounds])
        nth = np.repeat(np.arange(len(rounds)), [len(w) for w, _ in rounds])
        ends = np.cumsum(np.bincount(of, minlength=len(words)))
        flat = np.empty(len(of), "<u4")
        flat[ends[of] - 1 - nth] = np.concatenate([ids for _, ids in rounds]).astype(np.uint32)
        raw, cuts = flat.tobytes(), (4 * ends).tolist()
        out = [raw[x:y] for x, y in zip([0, *cuts], cuts)]
        for w in np.unique(np.searchsorted(starts, lone, side="right") - 1).tolist():
            out[w] = self.with_bytes(words[w], int(starts[w]), last, back)
        return out

    def with_bytes(self, word: str, start: int, last: np.ndarray, back: np.ndarray) -> bytes:
        """The ids of a word with characters that are in no piece: their UTF-8 bytes stand for them."""
        ids: list[int] = []
        at = start + len(word)
        while at > start:
            if last[at] >= 0:
                ids.append(int(last[at]))
            else:
                ids += [self.byte[x] for x in reversed(word[at - 1 - start].encode("utf-8"))]
            at = int(back[at])
        return np.array(ids[::-1], "<u4").tobytes()


class TextEncoder:
    """Encodes texts by their words, each distinct one once, until the store is full."""

    def __init__(self, path: str):
        self.vocabulary = PieceVocabulary(path)
        self.ids: dict[str, bytes] = {}

    def encode_raw(self, texts: list[str]) -> list[bytes]:
        """The ids of texts that the model has normalized, as little-endian 32-bit numbers."""
        units = list(map(self.vocabulary.units.findall, texts))
        used = set().union(*units)
        if len(self.ids) + len(used) > WORDS_KEPT:
            self.ids.clear()
        new = sorted(used.difference(self.ids))
        if new:
            self.ids.update(zip(new, self.vocabulary.encode_words(new)))
        ids = self.ids
        return [b"".join(map(ids.__getitem__, u)) for u in units]

    def decode_raw(self, ids: bytes) -> str:
        """Pieces joined, bytes put together (what is no UTF-8 becomes a replacement character), spaces restored and the first one, which encoding puts there, taken off."""
        v, rows = self.vocabulary, np.frombuffer(ids, "<u4")
        sizes = v.flat_sizes[rows]
        shift = v.flat_starts[rows] - (np.cumsum(sizes) - sizes)
        joined = v.flat[np.repeat(shift, sizes) + np.arange(sizes.sum())]
        return joined.tobytes().decode("utf-8", "replace").removeprefix(" ")

    def encode(self, texts: list[str]) -> list[list[int]]:
        return [np.frombuffer(x, "<u4").tolist() for x in self.encode_raw(list(map(self.vocabulary.model.normalize, texts)))]

    def decode(self, ids: list[int]) -> str:
        return self.decode_raw(np.array(ids, "<u4").tobytes())


_encoders: dict[str, TextEncoder] = {}


def _encoder(path: str) -> TextEncoder:
    return _encoders.get(path) or _encoders.setdefault(path, TextEncoder(path))


def encode_documents(docs: DataFrame, model: str, with_ids: bool = True, with_decoded: bool = False) -> DataFrame:
    """``doc_id, n_ids, ids_crc32, decoded_same`` (and ``ids``, and the text ``decoded`` from them) of each row of ``docs(doc_id, text)``.

    ``decoded_same``: decoding gives the text back, up to the model's own normalization. Null and empty texts have no ids.
    Repeated rows and null ids stay; other columns are not read; an empty table gives an empty result.
    """
    schema = "doc_id long, n_ids long, ids_crc32 long, decoded_same boolean" + ", ids array<int>" * with_ids + ", decoded string" * with_decoded

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        gc.disable()  # no cycles are made here, and looking for them in the stores takes long
        encoder = _encoder(model)
        for batch in batches:
            for part in slices(batch, at_once=BYTES_AT_ONCE):
                texts = [t or "" for t in part.column("text").to_pylist()]
                normal = list(map(encoder.vocabulary.model.normalize, texts))
                found = encoder.encode_raw(normal)
                decoded = list(map(encoder.decode_raw, found))
                columns = {
                    "doc_id": part.column("doc_id"),
                    "n_ids": pa.array([len(x) // 4 for x in found], pa.int64()),
                    "ids_crc32": pa.array(map(zlib.crc32, found), pa.int64()),
                    "decoded_same": pa.array([x == t.replace(SPACE, " ").removeprefix(" ") for x, t in zip(decoded, normal)]),
                }
                if with_ids:
                    ends = np.cumsum([0, *(len(x) // 4 for x in found)]).astype(np.int32)
                    columns["ids"] = pa.ListArray.from_arrays(pa.array(ends), pa.array(np.frombuffer(b"".join(found), "<i4")))
                if with_decoded:
                    columns["decoded"] = pa.array(decoded, pa.string())
                yield pa.RecordBatch.from_pydict(columns)

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(run, schema)


def decode_documents(encoded: DataFrame, model: str) -> DataFrame:
    """``doc_id, text`` from ``encoded(doc_id, ids)``; null ids give an empty text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _encoder(model)
        for batch in batches:
            texts = [encoder.decode(ids or []) for ids in batch.column("ids").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(texts, pa.string())], ["doc_id", "text"])

    return encoded.select(F.col("doc_id").cast("long"), "ids").mapInArrow(run, "doc_id long, text string")
