"""SentencePiece encoding and decoding by a batched numpy Viterbi search.

A text is cut at its spaces into words (a space is the piece mark in front
of a word) and around line feeds and tabs that are in no piece; no piece of a
model that splits at white space crosses such a cut, so the best segmentation
of the text is that of its words. New words of
a batch are grouped by length and each group advances together: polynomial
prefix hashes give the hash of every substring, a binary search probes the
sorted keys of the pieces of that length, and for each end position the
maximum over piece lengths stores score and backpointer for all words at
once. The segmentation has the highest sum of piece scores; equal sums go to
the longer last piece. Characters without a piece become byte pieces.

Words of more than ``LONG`` code points (scripts without spaces) are cut into
windows of ``WINDOW`` that all advance together, whatever word they are of.
First each window goes from every one of the last positions before it, which
gives the best score from any state at its start to any at its end. The states
are then joined window by window, and with the true state at its start known,
each window advances once more for the backpointers. So a word of any length
takes linear time, in bounded blocks, and no window depends on a guess.

The model file is read on the driver; its pieces (a fixed vocabulary) travel
with the tasks.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass, field
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

MODEL = "/opt/tokenizers/piece_bpe_32k.model"
MARK = "▁"             # fixed value: the piece mark that stands for a space
UNKNOWN_PENALTY = 10.0      # fixed value: below the lowest piece score, as in the library's unigram search
CACHE_WORDS = 300_000       # segmentations that a task keeps
CHUNK_CHARS = 1_000_000     # text encoded at once
BLOCK_CELLS = 50_000        # words times length that advance together
LONG = 64                   # a word longer than this goes by windows and is not cached
WINDOW = 128                # code points of a window
WINDOW_CELLS = 65_536       # windows times length that advance together
NOTHING = 0x110000          # beyond the code points: stands before and after a text

_BASE = np.uint64(0x9E3779B97F4A7C15)


@dataclass
class Pieces:
    """The vocabulary, sorted for probing. For each length: sorted hashes,
    the code points of the pieces, ids and scores."""

    tables: dict = field(default_factory=dict)
    byte_ids: list = field(default_factory=list)
    unknown_score: float = 0.0
    surface: list = field(default_factory=list)     # bytes of each id
    words: str = " *[^ ]+| +"                       # what a text is cut into

    @staticmethod
    def load(path: str = MODEL) -> "Pieces":
        import sentencepiece
        m = sentencepiece.SentencePieceProcessor(model_file=path)
        rows = [(m.id_to_piece(i), m.get_score(i)) for i in range(m.get_piece_size())]
        kinds = ["byte" if m.is_byte(i) else "none" if m.is_control(i) or m.is_unknown(i) or m.is_unused(i) else "text"
                 for i in range(len(rows))]
        return Pieces.build(rows, kinds)

    @staticmethod
    def build(rows: list[tuple[str, float]], kinds: list[str]) -> "Pieces":
        out = Pieces(byte_ids=[-1] * 256, surface=[b""] * len(rows))
        by_length: dict = {}
        for i, ((piece, score), kind) in enumerate(zip(rows, kinds)):
            if kind == "byte":
                value = int(piece[3:5], 16)     # "<0x41>"
                out.byte_ids[value], out.surface[i] = i, bytes([value])
            elif kind == "text":
                piece = piece.replace(MARK, " ")
                out.surface[i] = piece.encode()
                by_length.setdefault(len(piece), []).append((piece, i, score))
        used = set("".join(p for p, _ in rows))
        breaks = "".join(re.escape(c) for c in "\n\r\t" if c not in used)
        if breaks:      # no piece can cross a character that is in none
            out.words = f" *[^ {breaks}]+| +|[{breaks}]"
        if -1 in out.byte_ids:
            raise ValueError("the model has no byte pieces")
        scores = [s for own in by_length.values() for _, _, s in own]
        out.unknown_score = min(scores, default=0.0) - UNKNOWN_PENALTY
        for length, own in by_length.items():
            points = np.array([[ord(c) for c in p] for p, _, _ in own], np.uint32)
            keys = prefix_hashes(points.T)[-1]
            by = np.argsort(keys, kind="stable")
            out.tables[length] = (keys[by], points[by], np.array([i for _, i, _ in own], np.int32)[by],
                                  np.array([s for _, _, s in own], np.float64)[by])
        return out


def prefix_hashes(points: np.ndarray) -> np.ndarray:
    """h[k]: hash of the first k code points of each column."""
    h = np.zeros((points.shape[0] + 1, points.shape[1]), np.uint64)
    for k in range(points.shape[0]):
        h[k + 1] = h[k] * _BASE + (points[k].astype(np.uint64) + np.uint64(1))
    return h


def _probe(points: np.ndarray, h: np.ndarray, length: int, table) -> tuple[np.ndarray, np.ndarray]:
    """For every start and word: score and id of the piece of this length
    that stands there (hash equal, then code points equal), or -inf."""
    keys, own, ids, scores = table
    power = np.uint64(pow(int(_BASE), length, 1 << 64))
    sub = h[length:] - h[:-length] * power
    at = np.searchsorted(keys, sub)
    at[at == len(keys)] = 0
    start, word = np.nonzero(keys[at] == sub)
    row = at[start, word]
    same = np.ones(len(row), bool)
    for k in range(length):
        same &= points[start + k, word] == own[row, k]
    start, word, row = start[same], word[same], row[same]
    score, id = np.full(sub.shape, -np.inf), np.full(sub.shape, -1, np.int32)
    score[start, word], id[start, word] = scores[row], ids[row]
    return score, id


def _probes(points: np.ndarray, pieces: Pieces) -> tuple[list[int], dict]:
    """Piece lengths, longest first, and for each ``_probe``; a character
    without a piece of its own has the unknown score and id -1."""
    size = len(points)
    h = prefix_hashes(points)
    lengths = sorted((x for x in pieces.tables if x <= size), reverse=True)
    probes = {x: _probe(points, h, x, pieces.tables[x]) for x in lengths}
    if 1 in probes:
        probes[1] = np.where(probes[1][1] < 0, pieces.unknown_score, probes[1][0]), probes[1][1]
    else:
        lengths.append(1)
        probes[1] = np.full(points.shape, pieces.unknown_score), np.full(points.shape, -1, np.int32)
    return lengths, probes


def _code_points(words: list[str]) -> np.ndarray:
    return np.frombuffer("".join(words).encode("utf-32-le", "surrogatepass"), np.uint32)


def _ids_of(ids: np.ndarray, text: str, pieces: Pieces) -> bytes:
    """Bytes of the ids of a text, from its pieces at their last positions
    (-2: no piece ends here, -1: a character without a piece)."""
    if not (ids == -1).any():
        return ids[ids != -2].astype(np.int32, copy=False).tobytes()
    return np.array(list(chain.from_iterable(
        [pieces.byte_ids[b] for b in text[c].encode("utf-8", "surrogatepass")] if i == -1 else [i]
        for c, i in enumerate(ids.tolist()) if i != -2)), np.int32).tobytes()


def viterbi(words: list[str], pieces: Pieces) -> list[bytes]:
    """Best segmentations of words of one length (in code points), as the
    bytes of int32 ids. Arrays are position by word, so each step runs over
    contiguous rows."""
    n, size = len(words), len(words[0])
    points = np.ascontiguousarray(_code_points(words).reshape(n, size).T)
    lengths, probes = _probes(points, pieces)
    best = np.zeros((size + 1, n))
    step = np.ones((size + 1, n), np.int32)
    for end in range(1, size + 1):
        top = best[end]
        top.fill(-np.inf)
        for x in lengths:
            if x <= end:
                new = best[end - x] + probes[x][0][end - x]
                better = new > top
                np.copyto(top, new, where=better)
                np.copyto(step[end], x, where=better)
    # all words walk back together
    out = np.full((size, n), -2, np.int32)
    where, rows = np.full(n, size), np.arange(n)
    while len(rows):
        p = where[rows]
        x = step[p, rows]
        for length in np.unique(x):
            own = x == length
            out[p[own] - 1, rows[own]] = probes[length][1][p[own] - length, rows[own]]
        where[rows] = p - x
        rows = rows[where[rows] > 0]
    out = np.ascontiguousarray(out.T)
    used = out != -2
    flat, ends = out[used].tobytes(), (4 * np.cumsum(used.sum(1))).tolist()
    found = [flat[i:j] for i, j in zip([0, *ends], ends)]
    for k in np.nonzero((out == -1).any(1))[0].tolist():
        found[k] = _ids_of(out[k], words[k], pieces)
    return found


def _advance(best: np.ndarray, lengths: list[int], probes: dict, back: int, last: np.ndarray | None = None,
             id: np.ndarray | None = None) -> None:
    """Fill best[back + 1:], position by window (and state), from its rows up
    to ``back``; ``last`` and ``id`` take the length and id of the last piece."""
    for end in range(back + 1, len(best)):
        top = best[end]
        for x in lengths:
            score = probes[x][0][end - x]
            new = best[end - x] + (score if best.ndim == 2 else score[:, None])
            better = new > top
            np.copyto(top, new, where=better)
            if last is not None:
                np.copyto(last[end - back - 1], x, where=better)
                np.copyto(id[end - back - 1], probes[x][1][end - x], where=better)


def viterbi_windows(words: list[str], pieces: Pieces) -> list[bytes]:
    """Best segmentations of words of any lengths, by windows. A window sees
    the ``back`` positions up to its start and ``WINDOW`` beyond."""
    back = max([1, *pieces.tables])
    count = [-(-len(w) // WINDOW) for w in words]
    # every word after ``back`` of nothing, filled up with nothing to whole windows
    first = np.cumsum([0, *[back + k * WINDOW for k in count]])
    points = np.full(first[-1], NOTHING, np.uint32)
    for at, w in zip(first.tolist(), words):
        points[at + back:at + back + len(w)] = _code_points([w])
    starts = np.concatenate([at + WINDOW * np.arange(k) for at, k in zip(first.tolist(), count)])
    opens = set((np.cumsum([0, *count])[:-1]).tolist())      # windows that begin a word
    last = np.ones((len(starts), WINDOW), np.min_scalar_type(back))
    ids = np.full((len(starts), WINDOW), -1, np.int32)
    state, group = None, max(1, WINDOW_CELLS // WINDOW)
    for g in range(0, len(starts), group):
        own = starts[g:g + group]
        block = np.ascontiguousarray(points[own[:, None] + np.arange(back + WINDOW)[None, :]].T)
        lengths, probes = _probes(block, pieces)
        # best score to each position from each of the ``back`` last positions up to the start
        way = np.full((back + WINDOW + 1, len(own), back), -np.inf)
        way[np.arange(1, back + 1), :, np.arange(back)] = 0.0
        _advance(way, lengths, probes, back)
        best = np.full((back + WINDOW + 1, len(own)), -np.inf)
        for k in range(len(own)):
            if g + k in opens:
                state = np.full(back, -np.inf)
                state[-1] = 0.0
            best[1:back + 1, k] = state
            state = (way[WINDOW + 1:, k, :] + state[None, :]).max(1)
        step, piece = np.ones((WINDOW, len(own)), last.dtype), np.full((WINDOW, len(own)), -1, np.int32)
        _advance(best, lengths, probes, back, step, piece)
        last[g:g + len(own)], ids[g:g + len(own)] = step.T, piece.T
    found, at = [], 0
    for w, k in zip(words, count):
        step, out = memoryview(last[at:at + k].reshape(-1)), np.full(len(w), -2, np.int32)
        ends, p = [], len(w)
        while p > 0:
            ends.append(p - 1)
            p -= step[p - 1]
        out[ends] = ids[at:at + k].reshape(-1)[ends]
        found.append(_ids_of(out, w, pieces))
        at += k
    return found


class Encoder:
    """Encodes texts; remembers the segmentation of short words."""

    def __init__(self, pieces: Pieces):
        self.pieces, self.known, self.cut = pieces, {}, re.compile(pieces.words).findall

    def words(self, text: str) -> list[str]:
        """A space goes before a text that is not empty. A literal piece
        mark has no piece of its own here, so it becomes bytes and is told
        from a space."""
        return self.cut(" " + text) if text else []

    def encode(self, texts: list[str]) -> list[list[int]]:
        return [np.frombuffer(x, np.int32).tolist() for x in self.encode_bytes(texts)]

    def encode_bytes(self, texts: list[str]) -> list[bytes]:
        """The bytes of the int32 ids of each text."""
        cut = [self.words(t) for t in texts]
        new = set(chain.from_iterable(cut))
        if len(self.known) + len(new) > CACHE_WORDS:     # words that come again stay
            self.known = {w: self.known[w] for w in new if w in self.known}
        new.difference_update(self.known)
        by_length: dict = {}
        for w in new:
            by_length.setdefault(len(w), []).append(w)
        got = self.known
        long = [w for size, own in by_length.items() if size > LONG for w in own]
        if long:
            got.update(zip(long, viterbi_windows(long, self.pieces)))
        for size, own in by_length.items():
            if size > LONG:
                continue
            for i in range(0, len(own), max(1, BLOCK_CELLS // size)):
                part = own[i:i + max(1, BLOCK_CELLS // size)]
                got.update(zip(part, viterbi(part, self.pieces)))
        out = [b"".join(map(got.__getitem__, ws)) for ws in cut]
        for w in long:
            del got[w]
        return out


class Decoder:
    """Texts of lists of ids: the exact inverse of the encoder. The bytes of
    all pieces lie in one array, from which those of all ids are gathered."""

    def __init__(self, surface: list[bytes]):
        self.size = np.array([len(x) for x in surface], np.int64)
        self.start = np.cumsum(self.size) - self.size
        self.blob = np.frombuffer(b"".join(surface), np.uint8)

    def decode(self, ids: np.ndarray, ends: np.ndarray) -> list[str]:
        """Texts of the lists that end at ``ends`` in ``ids``."""
        if len(ids) and (ids.min() < 0 or ids.max() >= len(self.size)):
            raise ValueError("an id is outside the vocabulary")
        size = self.size[ids]
        upto = np.concatenate([[0], np.cumsum(size)])
        raw = self.blob[np.repeat(self.start[ids] - upto[:-1], size) + np.arange(upto[-1])].tobytes()
        at = upto[np.concatenate([[0], ends])].tolist()
        return [(raw[i + 1:j] if raw[i:i + 1] == b" " and j > i else raw[i:j]).decode("utf-8", "replace")
                for i, j in zip(at, at[1:])]


def decode_ids(ids, surface: list[bytes]) -> str:
    """The text of one list of ids."""
    return Decoder(surface).decode(np.array(ids, np.int64), np.array([len(ids)]))[0]


def _slices(sizes: list[int], most: int = CHUNK_CHARS) -> Iterator[tuple[int, int]]:
    at, total = 0, 0
    for i, n in enumerate(sizes):
        if total and total + n > most:
            yield at, i
            at, total = i, 0
        total += n
    if at < len(sizes):
        yield at, len(sizes)


def encode(docs: DataFrame, model: str = MODEL, text: str = "text", id: str = "doc_id", keep: tuple[str, ...] = ()) \
        -> DataFrame:
    """``(doc_id, *keep, ids array<int>, n_tokens)`` of every row.

    Null and empty texts have no ids. Texts are encoded whole, in linear time
    whatever their length, with spaces or without; repeated rows and null ids
    stay as they are. Columns not named in ``keep`` are left out; ``keep`` may
    not name ``doc_id``, ``ids`` or ``n_tokens``, or a column twice.
    """
    if len({"doc_id", "ids", "n_tokens", *keep}) < 3 + len(keep):
        raise ValueError("keep names a column of the result, or one twice")
    pieces = Pieces.load(model)
    names = [id, *keep]
    kinds = ", ".join(f"`{'doc_id' if c == id else c}` {docs.schema[c].dataType.simpleString()}" for c in names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = Encoder(pieces)
        for b in batches:
            column = b.column(len(names))
            for i, j in _slices(pa.compute.utf8_length(column).fill_null(0).to_pylist()):
                got = coder.encode_bytes(["" if t is None else t for t in column.slice(i, j - i).to_pylist()])
                n = np.array([len(x) // 4 for x in got], np.int64)
                flat = np.frombuffer(b"".join(got), np.int32)
                ids = pa.ListArray.from_arrays(np.concatenate([[0], np.cumsum(n)]).astype(np.int32), flat)
                yield pa.RecordBatch.from_arrays([*[b.column(k).slice(i, j - i) for k in range(len(names))], ids,
                                                  pa.array(n)],
                                                 names=["doc_id", *keep, "ids", "n_tokens"])

    rows = docs.select(*[F.col(f"`{c}`") for c in names], F.col(f"`{text}`").alias("_text"))
    return rows.mapInArrow(run, f"{kinds}, ids array<int>, n_tokens bigint")


def decode(encoded: DataFrame, model: str = MODEL, ids: str = "ids", keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """``(*keep, text)``: the texts of lists of ids (null as empty); ids
    outside the vocabulary are an error."""
    surface = Pieces.load(model).surface
    kinds = ", ".join(f"`{c}` {encoded.schema[c].dataType.simpleString()}" for c in keep)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        decoder = Decoder(surface)
        for b in batches:
            size = pa.compute.list_value_length(b.column(len(keep))).fill_null(0).to_numpy(zero_copy_only=False)
            for i, j in _slices(size.tolist(), CHUNK_CHARS // 4):
                own = b.column(len(keep)).slice(i, j - i)
                texts = decoder.decode(own.flatten().to_numpy(zero_copy_only=False), np.cumsum(size[i:j]))
                yield pa.RecordBatch.from_arrays([*[b.column(k).slice(i, j - i) for k in range(len(keep))],
                                                  pa.array(texts, pa.string())], names=[*keep, "text"])

    return encoded.select(*[F.col(f"`{c}`") for c in keep], F.col(f"`{ids}`")).mapInArrow(run, f"{kinds}, text string")
