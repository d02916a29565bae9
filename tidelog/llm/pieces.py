"""SentencePiece encoding and decoding with the N best segmentations.

The model file gives the pieces; a piece's score is its log probability under Zipf's law by rank, in millionths, as the
file holds ranks of merges and no probabilities. A forward Viterbi pass over the piece lattice gives every position its
best score from the start. These are exact heuristics for an A* search from the end back to the start, which therefore
finishes segmentations best first.

No piece reaches over a line break, or from a letter over the blank before the next word, so the lattice of a text falls
into independent parts; the worker keeps what it found for parts that come again. New parts of a batch pass forward side by
side, and the search of each goes on until its first path is at the start: what the least open state costs more is then
exactly what the second best costs more. Only where the N best of a text may change a part does its search go on.
"""

from __future__ import annotations

import heapq
import math
import re
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidelog.llm.common import returning_memory, small_batches

MODEL = "/opt/tokenizers/piece_bpe_32k.model"
_SIDE_BY_SIDE, _LONG_PART = 1 << 17, 48  # characters that pass forward at once, and of a part that passes alone
_BATCH_CHARS = 2_000_000
PARTS_KEPT = 200_000  # in each of two generations, about 50 MB of a worker's memory
_PART = re.compile(r" +[^ \n]*|[^ \n]+|\n")
_CHOICES_KEPT = 20_000
_NOT_THERE = -(1 << 30)  # score of an edge that is not there
_NONE = 1 << 60  # cost of a second best that is not there


@dataclass(frozen=True)
class Vocabulary:
    """Pieces with blanks for the model's word marks; ids of the 256 byte pieces."""

    name: str
    pieces: tuple[tuple[str, int, int], ...]  # text, id, score
    byte_ids: tuple[int, ...]
    byte_score: int


def load_vocabulary(path: str = MODEL) -> Vocabulary:
    """Reads a model file with byte pieces. Control, unknown and unused pieces take no part."""
    from sentencepiece import SentencePieceProcessor

    model = SentencePieceProcessor(model_file=path)
    plain, byte_ids = [], {}
    for i in range(model.get_piece_size()):
        piece = model.id_to_piece(i)
        if model.is_byte(i):
            byte_ids[int(piece[1:-1], 16)] = i
        elif not (model.is_control(i) or model.is_unknown(i) or model.is_unused(i)):
            plain.append((piece.replace("▁", " "), i))
    if len(byte_ids) != 256:
        raise ValueError(f"{path} lacks byte pieces")
    harmonic = sum(1 / r for r in range(1, len(plain) + 1))
    scored = tuple((text, i, -round(1e6 * math.log(r * harmonic))) for r, (text, i) in enumerate(plain, 1))
    if any("\n" in p or re.search(r"[^ ] ", p) for p, _, _ in scored if len(p) > 1):
        raise ValueError(f"a piece of {path} reaches over a word's end or a line break")
    return Vocabulary(path, scored, tuple(byte_ids[b] for b in range(256)), min(s for _, _, s in scored) - 10_000_000)


class Segmenter:
    def __init__(self, vocabulary: Vocabulary) -> None:
        self.vocabulary = vocabulary
        self.trie: dict = {}
        for text, i, score in vocabulary.pieces:
            node = self.trie
            for c in text:
                node = node.setdefault(c, {})
            if "" not in node:
                node[""] = (score, (i,))
        self.bytes_of = {i: text.encode() for text, i, _ in vocabulary.pieces}
        self.bytes_of |= {i: bytes([b]) for b, i in enumerate(vocabulary.byte_ids)}
        self.edges = _Edges(vocabulary)
        self.forget()

    def lattice(self, part: str) -> list[list[tuple[int, int, tuple[int, ...]]]]:
        """Edges (start, score, ids) by end. A character that is no piece is one edge of its bytes."""
        ends: list[list] = [[] for _ in range(len(part) + 1)]
        for start, c in enumerate(part):
            node, end = self.trie.get(c), start
            if node is None or "" not in node:
                ids = tuple(self.vocabulary.byte_ids[b] for b in c.encode("utf-8", "replace"))
                ends[start + 1].append((start, self.vocabulary.byte_score * len(ids), ids))
            while node is not None:
                end += 1
                if "" in node:
                    ends[end].append((start, *node[""]))
                node = node.get(part[end]) if end < len(part) else None
        return ends

    def best(self, part: str, n: int) -> list[tuple[int, tuple[int, ...]]]:
        """The n best segmentations (score, ids), best first."""
        ends = self.lattice(part)
        forward = [0] * len(ends)
        for end in range(1, len(ends)):
            forward[end] = max([forward[i] + s for i, s, _ in ends[end]])
        found: list = []
        last, number = len(part), 0
        heap = [(-forward[last], last, 0, 0, None)]  # among equals what lies nearest to the start goes on, the latest first
        while heap and len(found) < n:
            _, at, _, score, chain = heapq.heappop(heap)
            if at == 0:
                ids: list[int] = []
                while chain is not None:
                    ids += chain[0]
                    chain = chain[1]
                found.append((score, tuple(ids)))
                continue
            for start, s, ids_here in ends[at]:
                number -= 1
                heapq.heappush(heap, (-(forward[start] + score + s), start, number, score + s, (ids_here, chain)))
        return found

    def forget(self) -> None:
        self.old, self.known, self.old_rows, self.choices = _Known(), _Known(), {}, {}
        self.rows = _Rows(self._add)

    def _turn(self) -> None:
        """Begins a new generation; parts of the last one that come again are taken over."""
        self.old, self.known, self.old_rows = self.known, _Known(), dict(self.rows)
        self.rows = _Rows(self._add)

    def _two_best(self, part: str) -> tuple[int, list[int], int]:
        """Score and ids of the best segmentation, and what the second best costs more.

        The search with exact heuristics up to its first path: of each state it goes on with what costs nothing, the rest stays
        open.
        """
        ends = self.lattice(part)
        forward = [0] * len(ends)
        for end in range(1, len(ends)):
            forward[end] = max([forward[i] + s for i, s, _ in ends[end]])
        at, chain, cost = len(part), [], _NONE
        while at > 0:
            out = sorted((forward[at] - forward[i] - s, i, ids) for i, s, ids in ends[at])
            if len(out) > 1:
                cost = min(cost, out[1][0])
            chain.append(out[0][2])
            at = out[0][1]
        return forward[-1], [i for ids in reversed(chain) for i in ids], cost

    def learn(self, texts: Iterable[str]) -> None:
        """Takes up the parts of all texts that are not known, side by side."""
        if len(self.rows) > PARTS_KEPT or self.known.used > 8 * PARTS_KEPT:
            self._turn()
        new = dict.fromkeys(part for t in texts if t for part in _PART.findall(" " + t))
        new = [part for part in new if part not in self.rows]
        again = [part for part in new if part in self.old_rows]
        if again:
            first = self.known.append_all(*self.old.read_all(np.array([self.old_rows[part] for part in again])))
            self.rows.update(zip(again, range(first, first + len(again))))
        lot, chars = [], 0
        for part in new:
            if part in self.old_rows or len(part) > _LONG_PART:
                continue
            lot.append(part)
            chars += len(part) + 1
            if chars > _SIDE_BY_SIDE:
                self._learn(lot)
                lot, chars = [], 0
        if lot:
            self._learn(lot)

    def _learn(self, parts: list[str]) -> None:
        first = self.known.append_all(*self.edges.search(parts))
        self.rows.update(zip(parts, range(first, first + len(parts))))

    def _add(self, part: str) -> int:
        row = self.old_rows.get(part)
        return self.known.append(*(self._two_best(part) if row is None else self.old.read(row)))

    def encode(self, text: str | None, n: int) -> tuple[np.ndarray, list[tuple[int, list]]]:
        """Ids of the best segmentation, and all n best as (score, changes to the best one).

        A change is (first piece, number of pieces, ids instead). A null or empty text has one empty segmentation.
        """
        if not text:
            return np.zeros(0, dtype=np.int32), [(0, [])]
        if len(self.rows) > PARTS_KEPT or self.known.used > 8 * PARTS_KEPT:
            self._turn()
        parts = _PART.findall(" " + text)
        rows = np.fromiter(map(self.rows.__getitem__, parts), dtype=np.int64, count=len(parts))
        lengths, scores, costs, ids = self.known.read_all(rows)
        offsets = np.cumsum(lengths) - lengths
        score = int(scores.sum())
        few = np.argsort(costs, kind="stable")[:n - 1] if len(costs) <= 4 * n else np.sort(
            np.argpartition(costs, n - 1)[:n - 1])
        few = [int(i) for i in few if costs[i] < _NONE]
        options = [self._options(parts[i], n) for i in few]
        found = []
        for cost, picks in cheapest([[o[0][0] - s for s, _ in o] for o in options], n):
            changes = [(int(offsets[i]), int(lengths[i]), list(o[p][1])) for i, o, p in zip(few, options, picks) if p]
            found.append((score - cost, sorted(changes)))
        return ids, found

    def _options(self, part: str, n: int) -> list[tuple[int, tuple[int, ...]]]:
        found = self.choices.get((part, n))
        if found is None:  # the parts that are cheapest to change are mostly the same frequent ones
            if len(self.choices) >= _CHOICES_KEPT:
                self.choices.clear()
            found = self.choices[part, n] = self.best(part, n)
        return found

    def decode(self, ids: Iterable[int]) -> str:
        text = b"".join(map(self.bytes_of.__getitem__, ids)).decode("utf-8", "replace")
        return text[1:] if text.startswith(" ") else text


class _Known:
    """Best segmentations by number: length, score, what the second best costs more, ids."""

    def __init__(self) -> None:
        self.n = self.used = 0
        self.length, self.score, self.second, self.start = (np.zeros(1024, dtype=np.int64) for _ in range(4))
        self.ids = np.zeros(8192, dtype=np.int32)

    def append(self, score: int, ids, second: int) -> int:
        row, self.n = self.n, self.n + 1
        if row == len(self.length):
            self.length, self.score, self.second, self.start = (
                np.concatenate([a, np.zeros_like(a)]) for a in (self.length, self.score, self.second, self.start))
        while self.used + len(ids) > len(self.ids):
            self.ids = np.concatenate([self.ids, np.zeros_like(self.ids)])
        self.ids[self.used:self.used + len(ids)] = ids
        self.length[row], self.score[row], self.second[row], self.start[row] = len(ids), score, second, self.used
        self.used += len(ids)
        return row

    def append_all(self, length: np.ndarray, score: np.ndarray, second: np.ndarray, ids: np.ndarray) -> int:
        """The number of the first of them."""
        first, n, used = self.n, self.n + len(length), self.used + len(ids)
        while n > len(self.length):
            self.length, self.score, self.second, self.start = (
                np.concatenate([a, np.zeros_like(a)]) for a in (self.length, self.score, self.second, self.start))
        while used > len(self.ids):
            self.ids = np.concatenate([self.ids, np.zeros_like(self.ids)])
        self.length[first:n], self.score[first:n], self.second[first:n] = length, score, second
        self.start[first:n] = self.used + np.cumsum(length) - length
        self.ids[self.used:used] = ids
        self.n, self.used = n, used
        return first

    def read(self, row: int):
        start = self.start[row]
        return self.score[row], self.ids[start:start + self.length[row]], self.second[row]

    def read_all(self, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        lengths = self.length[rows]
        offsets = np.cumsum(lengths) - lengths
        ids = self.ids[np.repeat(self.start[rows] - offsets, lengths) + np.arange(int(lengths.sum()))]
        return lengths, self.score[rows], self.second[rows], ids


class _Edges:
    """The vocabulary's trie as arrays, and the search over the lattices of many parts side by side."""

    def __init__(self, vocabulary: Vocabulary) -> None:
        self.vocabulary = vocabulary
        nodes, piece = {"": 0}, {}
        for text, i, score in vocabulary.pieces:
            for end in range(1, len(text) + 1):
                nodes.setdefault(text[:end], len(nodes))
            piece.setdefault(nodes[text], (i, score))
        steps = sorted((nodes[t[:-1]] << 21 | ord(t[-1]), node) for t, node in nodes.items() if t)
        self.steps = np.array([k for k, _ in steps] + [np.iinfo(np.int64).max])
        self.to = np.array([node for _, node in steps] + [0])
        self.piece = np.array([piece.get(k, (-1, 0))[0] for k in range(len(nodes))], dtype=np.int32)
        self.score = np.array([piece.get(k, (-1, 0))[1] for k in range(len(nodes))], dtype=np.int32)
        self.longest = max(len(t) for t, _, _ in vocabulary.pieces)

    def search(self, parts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Number of ids, score and what the second best costs more of each part, and the ids of all, one after another."""
        sizes = np.fromiter(map(len, parts), dtype=np.int64, count=len(parts))
        last = np.cumsum(sizes + 1) - 1  # the places of a part are those of its characters and its end
        first = last - sizes
        codes = np.frombuffer("\n".join([*parts, ""]).encode("utf-32-le", "surrogatepass"), dtype=np.uint32).astype(np.int64)
        codes[last] = (1 << 21) - 1  # no character: no piece reaches over it
        score = np.full((self.longest, len(codes)), _NOT_THERE, dtype=np.int32)  # by length - 1 and start
        ids = np.full((self.longest, len(codes)), -1, dtype=np.int32)
        start, node = np.arange(len(codes)), np.zeros(len(codes), dtype=np.int64)
        for length in range(self.longest):
            key = node << 21 | codes[start + length]
            at = np.searchsorted(self.steps, key)
            hit = self.steps[at] == key
            start, node = start[hit], self.to[at[hit]]
            if not len(start):
                break
            found = self.piece[node] >= 0
            score[length, start[found]], ids[length, start[found]] = self.score[node[found]], self.piece[node[found]]
        as_bytes = 1 + (codes >= 0x80) + (codes >= 0x800) + (codes >= 0x10000)
        as_bytes[(codes >= 0xD800) & (codes < 0xE000)] = 1  # half a pair becomes a question mark
        score[0] = np.where(ids[0] < 0, self.vocabulary.byte_score * as_bytes, score[0])

        forward, gap, step = (np.zeros(len(codes), dtype=np.int64) for _ in range(3))
        order = np.argsort(-sizes, kind="stable")
        by_size, many = first[order], len(parts)
        for place in range(1, int(sizes.max(initial=0)) + 1):
            while sizes[order[many - 1]] < place:
                many -= 1
            here = by_size[:many] + place
            best, second = np.full(many, -_NONE), np.full(many, -_NONE)
            taken = np.zeros(many, dtype=np.int64)
            for length in range(1, min(place, self.longest) + 1):  # among equals the longest
                edge = score[length - 1, here - length]
                total = np.where(edge == _NOT_THERE, -_NONE, forward[here - length] + edge)
                better = (total >= best) & (edge != _NOT_THERE)
                second = np.where(better, best, np.maximum(second, total))
                best, taken = np.where(better, total, best), np.where(better, length, taken)
            forward[here], step[here], gap[here] = best, taken, np.where(second == -_NONE, _NONE, best - second)

        cost, at, open_ = np.full(len(parts), _NONE), last.copy(), np.flatnonzero(sizes)
        taken = np.zeros(len(codes), dtype=np.int64)
        while len(open_):
            here = at[open_]
            cost[open_] = np.minimum(cost[open_], gap[here])
            at[open_] = here - step[here]
            taken[at[open_]] = step[here]
            open_ = open_[at[open_] > first[open_]]
        starts = np.flatnonzero(taken)
        chosen = ids[taken[starts] - 1, starts]
        size = np.where(chosen < 0, as_bytes[starts], 1)
        flat, ends = np.repeat(chosen, size), np.cumsum(size)
        for k in np.flatnonzero(chosen < 0).tolist():
            flat[ends[k] - size[k]:ends[k]] = [self.vocabulary.byte_ids[b] for b in chr(codes[starts[k]]).encode("utf-8", "replace")]
        whole = np.concatenate([[0], ends])
        length = whole[np.searchsorted(starts, last)] - whole[np.searchsorted(starts, first)]
        return length, forward[last], cost, flat


class _Rows(dict):
    def __init__(self, add) -> None:
        self.add = add

    def __missing__(self, part: str) -> int:
        self[part] = row = self.add(part)
        return row


def cheapest(costs: list[list[int]], n: int) -> list[tuple[int, tuple[int, ...]]]:
    """The n cheapest picks of one option per list (each list rising from 0), cheapest first."""
    heap, seen, found = [(0, (0,) * len(costs))], set(), []
    while heap and len(found) < n:
        cost, picks = heapq.heappop(heap)
        if picks in seen:
            continue
        seen.add(picks)
        found.append((cost, picks))
        for i, p in enumerate(picks):
            if p + 1 < len(costs[i]):
                heapq.heappush(heap, (cost + costs[i][p + 1] - costs[i][p], (*picks[:i], p + 1, *picks[i + 1:])))
    return found


ENCODED = ("doc_id bigint, n_chars bigint, n_pieces bigint, score double, ids array<int>, "
           "nbest array<struct<score:double,n_pieces:bigint,"
           "changes:array<struct<first:int,n:int,ids:array<int>>>>>, decodes boolean")
_CHANGE = pa.struct([("first", pa.int32()), ("n", pa.int32()), ("ids", pa.list_(pa.int32()))])
_NBEST = pa.list_(pa.struct([("score", pa.float64()), ("n_pieces", pa.int64()), ("changes", pa.list_(_CHANGE))]))
_ROWS = 256


def encode_documents(docs: DataFrame, n: int = 4, vocabulary: Vocabulary | None = None) -> DataFrame:
    """doc_id, n_chars, n_pieces, score, ids, nbest, decodes: one row per row of ``docs``.

    ``ids`` is the best segmentation, ``nbest`` holds up to ``n`` of them, best first, as changes to ``ids``; ``decodes``
    tells that the ids give back the very text. Null and empty texts have no ids and one segmentation with score 0.
    Equal scores come in a fixed order. Repeated rows are encoded alike; other columns are not looked at.
    """
    small_batches(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(vocabulary or load_vocabulary())  # tens of thousands of pieces

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = Segmenter(shared.value)  # gone with the task: workers go on to other stages, and what they keep counts there
        for batch in batches:
            for start in range(0, len(batch), _ROWS):
                yield _encoded(batch.slice(start, _ROWS), own, n)

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(returning_memory(rows), ENCODED)


def _encoded(batch: pa.RecordBatch, own: Segmenter, n: int) -> pa.RecordBatch:
    texts = [t or "" for t in batch.column("text").to_pylist()]
    lot, chars = [], 0
    made = []
    for t in texts:  # a lot's parts are taken up together
        lot.append(t)
        chars += len(t)
        if chars > _BATCH_CHARS:
            own.learn(lot)
            made += [own.encode(x, n) for x in lot]
            lot, chars = [], 0
    own.learn(lot)
    made += [own.encode(x, n) for x in lot]
    sizes = np.array([len(ids) for ids, _ in made], dtype=np.int64)
    flat = np.concatenate([ids for ids, _ in made]) if made else np.zeros(0, dtype=np.int32)
    nbest = [[{"score": s / 1e6, "n_pieces": int(size) + sum(len(i) - k for _, k, i in changes),
               "changes": [{"first": a, "n": k, "ids": i} for a, k, i in changes]} for s, changes in found]
             for size, (_, found) in zip(sizes, made)]
    return pa.RecordBatch.from_arrays([
        batch.column("doc_id"), pa.array([len(t) for t in texts], pa.int64()), pa.array(sizes),
        pa.array([found[0][0] / 1e6 for _, found in made], pa.float64()),
        pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(sizes)]), pa.int32()), pa.array(flat, pa.int32())),
        pa.array(nbest, _NBEST), pa.array([own.decode(ids.tolist()) == t for t, (ids, _) in zip(texts, made)], pa.bool_()),
    ], names=["doc_id", "n_chars", "n_pieces", "score", "ids", "nbest", "decodes"])
