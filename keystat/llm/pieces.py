"""SentencePiece encoding and decoding with N-best segmentations.

The pieces and scores of a given model form a lattice over a text: an edge for
every piece that matches, and the bytes of a character that no piece covers. The
best segmentation has the largest sum of scores. A forward Viterbi pass gives the
best score of every prefix; they are exact heuristics for a backward A* search,
which then meets complete segmentations in order of their scores.

A space counts as the mark U+2581, and one is put before the text. No piece has
a mark after another character, so each lattice is a chain of independent units (marks and
the characters up to the next mark); a unit also ends after a letter before such signs as no piece
has after a letter, mostly punctuation, for no edge spans that place. Units' Viterbi passes are remembered. The
pass also tells what a unit's second best segmentation loses: the least that
another edge into a place on the best path loses. So only the N - 1 units that
lose least need the A* search, and the N best of a text are the N best sums over them. The pieces
that stand for runs of marks are no ordinary ones (their score is -1e9) and lose
to single marks. A literal U+2581, unlike a space, is encoded in bytes, so decoding gives back
every text exactly.

A null or empty text has no pieces; rows are kept one for one; repeated rows,
long texts, nulls elsewhere and extra columns need no care; an empty table gives an
empty result. The model file is read by the driver, at most ``MODEL_BYTES`` of
it, and broadcast. Equal scores are ordered by the search, the same way each time.
"""

from __future__ import annotations

import hashlib
import heapq
import re
import struct
from array import array
from collections.abc import Iterator
from itertools import accumulate

import numpy as np
import pyarrow as pa
from pyspark import SparkContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from keystat.llm.common import handing_back, ship_package

MODEL = "/opt/tokenizers/piece_bpe_32k.model"
MODEL_BYTES = 64 << 20
MARK = "▁"
NBEST = 3
#: Units and searches remembered by a task's process, each, and the longest that is.
REMEMBERED = 200_000
REMEMBERED_LENGTH = 48
#: Texts of so many characters are cut before their new units are searched together; the longest such unit.
LEARNED_BYTES = 1 << 19
LEARNED_LENGTH = 32
#: Characters of the table in which they are.
TABLE_CHARACTERS = [chr(c) for c in range(0x20, 0x100)]
#: Characters after which a run of rows goes out.
RUN_BYTES = 1 << 20
#: What a byte costs more than the worst ordinary piece.
BYTE_PENALTY = 10.0
_LETTERS = "".join(chr(c) for c in range(128) if chr(c).isalpha())
_SIGNS = "".join(chr(c) for c in range(33, 127) if not chr(c).isalnum())


class Pieces:
    """A model's pieces as a trie, with the searches over its lattices."""

    def __init__(self, proto: bytes):
        import sentencepiece
        model = sentencepiece.SentencePieceProcessor(model_proto=proto)
        n = model.get_piece_size()
        ordinary = [i for i in range(n) if not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i)
                                                or model.is_unused(i))]
        worst = min((model.get_score(i) for i in ordinary if model.get_score(i) > -1e8), default=0.0)
        self.byte_score = worst - BYTE_PENALTY
        self.byte_id = {int(model.id_to_piece(i)[3:5], 16): i for i in range(n) if model.is_byte(i)}
        self.surface: list[bytes] = [b""] * n
        for b, i in self.byte_id.items():
            self.surface[i] = bytes([b])
        self.trie: dict = {}
        after_letter: set[str] = set()
        self.longest = max((len(model.id_to_piece(i)) for i in ordinary), default=1)
        for i in ordinary:
            piece = model.id_to_piece(i)
            if MARK in piece.lstrip(MARK):
                raise ValueError("a piece with an inner mark: texts can't be cut at marks")
            self.surface[i] = piece.replace(MARK, " ").encode()
            after_letter.update(b for a, b in zip(piece, piece[1:]) if a in _LETTERS)
            node = self.trie
            # in the trie a mark is a space: a literal mark of a text matches nothing
            step: list = []
            for c in piece.replace(MARK, " "):
                step = node.setdefault(c, [{}, -1, 0.0])  # what follows, the piece that ends here, its score
                node = step[0]
            step[1:] = i, model.get_score(i)
        self.surfaces = pa.array(self.surface, pa.large_binary())
        # spaces and what follows up to the next space or such a sign, line feeds apart
        signs = "".join(re.escape(c) for c in _SIGNS if c not in after_letter)
        # (no shorter run of letters, of others or of spaces could match: nothing is tried again)
        ended = f"[^ \\n{_LETTERS}]*+[{_LETTERS}]++(?=[{signs}])|" if signs else ""
        self.unit = re.compile(" *+(?:" + ended + r"[^ \n]++)| ++|\n")
        self.units = _Remembered(self.viterbi)
        self.table = _Table(self.trie)
        self.searches = _Remembered(lambda key: self.nbest(*key), lambda key: len(key[0]))

    def edges(self, text: str) -> list[list[tuple[int, float, tuple[int, ...]]]]:
        """For every end, its edges: (start, score, ids)."""
        into: list[list] = [[] for _ in range(len(text) + 1)]
        for start in range(len(text)):
            node, end, single = self.trie, start, False
            for c in text[start:start + self.longest]:
                step = node.get(c)
                if step is None:
                    break
                node, i, score = step
                end += 1
                if i >= 0:
                    into[end].append((start, score, (i,)))
                    single |= end == start + 1
            if not single:
                ids = tuple(self.byte_id[b] for b in text[start].encode("utf-8", "surrogatepass"))
                into[start + 1].append((start, self.byte_score * len(ids), ids))
        return into

    def viterbi(self, text: str) -> tuple[float, bytes, float]:
        """(score, ids as little-endian int32, what the second best loses) of a unit."""
        n, nothing, longest = len(text), float("-inf"), self.longest
        best, second = [nothing] * (n + 1), [nothing] * (n + 1)
        best[0] = 0.0
        into: list = [None] * (n + 1)
        for start in range(n):
            before, node, end, single = best[start], self.trie, start, False
            for c in text[start:start + longest]:
                step = node.get(c)
                if step is None:
                    break
                node, piece, score = step
                end += 1
                if piece >= 0:
                    score += before
                    if score > best[end]:
                        best[end], second[end], into[end] = score, best[end], (start, piece)
                    elif score > second[end]:
                        second[end] = score
                    if end == start + 1:
                        single = True
            if not single:
                ids = [self.byte_id[b] for b in text[start].encode("utf-8", "surrogatepass")]
                score = before + self.byte_score * len(ids)
                end = start + 1
                if score > best[end]:
                    best[end], second[end], into[end] = score, best[end], (start, ids)
                elif score > second[end]:
                    second[end] = score
        path, at, loss = [], n, float("inf")
        while at:
            loss = min(loss, best[at] - second[at])
            at, ids = into[at]
            if isinstance(ids, list):
                path += ids[::-1]
            else:
                path.append(ids)
        return best[n], struct.pack(f"<{len(path)}i", *path[::-1]), loss

    def nbest(self, text: str, n: int) -> list[tuple[float, bytes]]:
        """Up to ``n`` best segmentations of a unit: (score, ids as little-endian int32)."""
        into = self.edges(text)
        best = [0.0] * (len(text) + 1)
        for end in range(1, len(text) + 1):
            best[end] = max(best[start] + score for start, score, _ in into[end])
        # backward from the end: the rest's score is known, the prefix's best is exact
        # among equal sums the one nearest to the start goes first, else ties would all be opened
        heap = [(-best[-1], len(text), 0, 0.0, None)]
        found, pushed = [], 0
        while heap and len(found) < n:
            _, at, _, rest, path = heapq.heappop(heap)
            if not at:
                ids: list[int] = []
                while path is not None:
                    ids += path[0]
                    path = path[1]
                found.append((rest, np.array(ids, "<i4").tobytes()))
                continue
            for start, score, ids in into[at]:
                pushed += 1
                heapq.heappush(heap, (-(best[start] + score + rest), start, pushed, score + rest, (ids, path)))
        return found

    def learn(self, units: set[str]) -> None:
        """Viterbi passes of those units that aren't remembered, all at once where the table knows their characters."""
        held = self.units
        if len(held) + len(units) > REMEMBERED // 2:
            held.turn()
        before, new = held.before, []
        for u in [u for u in units if u not in held]:
            found = before.get(u)
            if found is not None:
                held[u] = found
            elif len(u) <= LEARNED_LENGTH:
                new.append(u)
        held.update(self.table.viterbi(new))

    def encode_all(self, texts: list[str], n: int) -> Iterator[list[tuple[float, bytes]]]:
        """:meth:`encode` of each text."""
        first = 0
        while first < len(texts):
            cut, size = [], 0
            while first + len(cut) < len(texts) and size < LEARNED_BYTES:
                cut.append(self.unit.findall(" " + texts[first + len(cut)]))
                size += len(texts[first + len(cut) - 1])
            self.learn(set().union(*cut))
            for units, text in zip(cut, texts[first:first + len(cut)], strict=True):
                yield self.encode(text, n, units)
            first += len(cut)

    def encode(self, text: str, n: int = 1, units: list[str] | None = None) -> list[tuple[float, bytes]]:
        """Up to ``n`` best segmentations of a whole text, best first."""
        if not text:
            return []
        units = units or self.unit.findall(" " + text)
        scores, parts, losses = zip(*map(self.units.__getitem__, units), strict=True)
        total, whole = sum(scores), b"".join(parts)
        if n == 1:
            return [(total, whole)]
        searched = {place: self.searches[units[place], n]
                    for loss, place in _least(losses, n - 1) if loss < float("inf")}
        loss = sorted((found[0][0] - found[r][0], place, r) for place, found in searched.items()
                      for r in range(1, len(found)))
        out = []
        for lost, changes in _least_sums(loss, n):
            own = list(parts) if changes else None
            for place, r in changes:
                own[place] = searched[place][r][1]
            out.append((total - lost, b"".join(own) if changes else whole))
        return out

    def decode_all(self, ids: np.ndarray, offsets: np.ndarray) -> tuple[bytes, list[int]]:
        """The texts of many segmentations (each with the space put before it), and where each starts."""
        if not len(ids):
            return b"", [0] * len(offsets)
        _, ends, data = self.surfaces.take(pa.array(ids)).buffers()
        ends = np.frombuffer(ends, np.int64, len(ids) + 1)
        return (data.to_pybytes() if data is not None else b"")[:ends[-1]], ends[offsets].tolist()

    def decode(self, ids: bytes) -> str:
        text = b"".join(map(self.surface.__getitem__, np.frombuffer(ids, "<i4").tolist()))
        return text[1:].decode("utf-8", "surrogatepass")


class _Remembered(dict):
    """Results by key, the latest ``REMEMBERED`` or so: half of them, and the half before, from which
    a key that is asked for again is taken over."""

    def __init__(self, compute, size=len):
        super().__init__()
        self.compute, self.size, self.before = compute, size, {}

    def __missing__(self, key):
        found = self.before.get(key)
        if found is None:
            found = self.compute(key)
        if self.size(key) <= REMEMBERED_LENGTH:
            if len(self) >= REMEMBERED // 2:
                self.turn()
            self[key] = found
        return found

    def turn(self) -> None:
        self.before = dict(self)
        self.clear()


class _Table:
    """The trie of the pieces made of ``TABLE_CHARACTERS`` as a table of nodes by characters, for Viterbi
    passes of many units at once. Node 0 leads nowhere, node 1 is the root."""

    def __init__(self, trie: dict):
        # a character that is no piece of its own would need its bytes
        known = [c for c in TABLE_CHARACTERS if c in trie and trie[c][1] >= 0][:255]
        self.code = {ord(c): i for i, c in enumerate(known, 1)}
        rows, pieces, scores, todo = [array("i", bytes(4 * (len(known) + 1)))], [-1, -1], [0.0, 0.0], [trie]
        for node in todo:  # grows as it goes: breadth first, a node's number is its place in it
            row = array("i", bytes(4 * (len(known) + 1)))
            for i, c in enumerate(known, 1):
                if c in node:
                    row[i] = len(pieces)
                    pieces.append(node[c][1])
                    scores.append(node[c][2])
                    todo.append(node[c][0])
            rows.append(row)
        self.next = np.array(rows, np.uint16 if len(pieces) < 1 << 16 else np.int32)
        self.piece, self.score = np.array(pieces, np.int32), np.array(scores)

    def viterbi(self, units: list[str]) -> dict[str, tuple[float, bytes, float]]:
        """What :meth:`Pieces.viterbi` gives of those units that are made of the table's characters."""
        units = [u for u in units if u]
        if not units:
            return {}
        points = np.frombuffer("".join(units).encode("utf-32-le", "surrogatepass"), np.uint32)
        codes = np.zeros(int(points.max()) + 1 if len(points) else 1, np.uint8)
        for c, i in self.code.items():
            if c < len(codes):
                codes[c] = i
        sizes = np.array([len(u) for u in units])
        longest = int(sizes.max())
        chars = np.zeros((len(units), longest), np.uint8)
        inside = np.arange(longest) < sizes[:, None]
        chars[inside] = codes[points]
        good = np.flatnonzero(((chars > 0) == inside).all(axis=1))
        chars, sizes = chars[good], sizes[good]
        n = len(good)
        # by places, then units: what is read and written at once lies together
        best = np.full((longest + 1, n), -np.inf)
        second, start_of = best.copy(), np.zeros((longest + 1, n), np.int16)
        piece_of = np.zeros((longest + 1, n), np.int32)
        best[0] = 0.0
        chars, following, width = np.ascontiguousarray(chars.T), self.next.ravel(), np.int32(self.next.shape[1])
        for start in range(longest):
            rows = np.flatnonzero(sizes > start)
            node = np.ones(len(rows), np.int32)
            before = best[start]
            for end in range(start, longest):
                node = following[node * width + chars[end][rows]]
                alive = np.flatnonzero(node)
                if not len(alive):
                    break
                rows, node = rows[alive], node[alive].astype(np.int32)
                piece = self.piece[node]
                hit = np.flatnonzero(piece >= 0)
                r, piece = rows[hit], piece[hit]
                best_at, second_at = best[end + 1], second[end + 1]
                score, old = before[r] + self.score[node[hit]], best_at[r]
                better = score > old
                second_at[r] = np.where(better, old, np.maximum(second_at[r], score))
                r, piece, score = r[better], piece[better], score[better]
                best_at[r], start_of[end + 1][r], piece_of[end + 1][r] = score, start, piece
        # back from the ends, all at once
        path = np.full((n, longest), -1, np.int32)
        loss, at, rows = np.full(n, np.inf), sizes.copy(), np.arange(n)
        for step in range(longest):
            rows = rows[at[rows] > 0]
            if not len(rows):
                break
            place = at[rows]
            loss[rows] = np.minimum(loss[rows], best[place, rows] - second[place, rows])
            path[rows, longest - 1 - step] = piece_of[place, rows]
            at[rows] = start_of[place, rows]
        used = path >= 0
        ids = path[used].astype("<i4").tobytes()
        ends = np.cumsum(used.sum(axis=1) * 4).tolist()
        paths = [ids[a:b] for a, b in zip([0, *ends[:-1]], ends)]
        return dict(zip([units[i] for i in good.tolist()],
                        zip(best[sizes, np.arange(n)].tolist(), paths, loss.tolist(), strict=True), strict=True))


def _least(losses: tuple[float, ...], n: int) -> list[tuple[float, int]]:
    """The ``n`` least with their places, the first places among equal ones."""
    left, found = list(losses), []
    for _ in range(min(n, len(left))):
        least = min(left)
        place = left.index(least)
        found.append((least, place))
        left[place] = float("inf")
    return found


def _least_sums(loss: list[tuple[float, int, int]], n: int) -> list[tuple[float, tuple]]:
    """The ``n`` least sums over subsets of the losses with one choice for each
    place: (sum, ((place, choice), ...)), the empty subset first."""
    heap, out = [(0.0, (), -1)], []
    while heap and len(out) < n:
        lost, changes, last = heapq.heappop(heap)
        out.append((lost, changes))
        for i in range(last + 1, len(loss)):
            more, place, r = loss[i]
            if all(place != p for p, _ in changes):
                heapq.heappush(heap, (lost + more, (*changes, (place, r)), i))
    return out


_loaded: dict[str, Pieces] = {}


def _pieces(proto: bytes) -> Pieces:
    """The model, kept for the life of the task's process."""
    name = hashlib.sha256(proto).hexdigest()
    if name not in _loaded:
        _loaded.clear()
        _loaded[name] = Pieces(proto)
    return _loaded[name]


def _round_trips(pieces: Pieces, texts: list[bytes], ids: np.ndarray, offsets: np.ndarray, rows: np.ndarray) -> list[bool]:
    """Whether all of each row's segmentations decode to its text. ``offsets`` cut the ids into
    segmentations, ``rows`` these into rows."""
    decoded, starts = pieces.decode_all(ids, offsets)
    same = []
    for text, a, b in zip(texts, rows[:-1].tolist(), rows[1:].tolist(), strict=True):
        # an empty text may have no ids, hence no space before it
        same.append(all(decoded[x + 1:y] == text for x, y in zip(starts[a:b], starts[a + 1:b + 1], strict=True)))
    return same


def _encode(shared, nbest: int, check: bool):
    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = _pieces(shared.value)
        for batch in handing_back(batches):
            keep = [i for i, c in enumerate(batch.schema.names) if c != "__text"]
            # rows go out in runs, so that long texts' pieces don't pile up
            column, first = batch.column("__text"), 0
            while first < batch.num_rows:
                texts, size, at = [], 0, first
                while at < batch.num_rows and size < RUN_BYTES:
                    texts.append(column[at].as_py() or "")
                    size += len(texts[-1])
                    at += 1
                rows = list(pieces.encode_all(texts, nbest))
                scores = [s for found in rows for s, _ in found]
                ids = [i for found in rows for _, i in found]
                offsets = np.array([0, *accumulate(len(x) // 4 for x in ids)], np.int32)
                values = np.frombuffer(b"".join(ids), "<i4")
                found = pa.StructArray.from_arrays(
                    [pa.array(scores, pa.float64()), pa.ListArray.from_arrays(pa.array(offsets), pa.array(values))],
                    names=["score", "ids"])
                places = np.array([0, *accumulate(len(x) for x in rows)], np.int32)
                columns = [*[batch.column(i).slice(first, at - first) for i in keep],
                           pa.ListArray.from_arrays(pa.array(places), found)]
                names = [*[batch.schema.names[i] for i in keep], "segmentations"]
                if check:
                    columns.append(pa.array(_round_trips(pieces, [t.encode() for t in texts], values, offsets, places), pa.bool_()))
                    names.append("round_trip")
                yield pa.RecordBatch.from_arrays(columns, names=names)
                first = at

    return encode


def _decode(shared):
    def texts(pieces: Pieces, column: pa.ListArray) -> list[str]:
        offsets = column.offsets.to_numpy()
        values = column.values.to_numpy()
        return [pieces.decode(values[a:b].astype("<i4").tobytes())
                for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist(), strict=True)]

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = _pieces(shared.value)
        for batch in batches:
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(texts(pieces, batch.column("pieces")), pa.string())],
                names=[*batch.schema.names, "decoded"])

    return decode


def _check(shared):
    def check(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = _pieces(shared.value)
        for batch in batches:
            same = []
            found = batch.column("segmentations")
            for row, value in enumerate(batch.column("__text")):
                segments = found[row].values
                if segments is None or not len(segments):
                    same.append(True)
                    continue
                ids = segments.field("ids")
                offsets = ids.offsets.to_numpy()
                values = ids.values.to_numpy()[offsets[0]:offsets[-1]]
                same += _round_trips(pieces, [(value.as_py() or "").encode()], values, offsets - offsets[0], np.array([0, len(ids)]))
            keep = [i for i, c in enumerate(batch.schema.names) if c != "__text"]
            yield pa.RecordBatch.from_arrays([*[batch.column(i) for i in keep], pa.array(same, pa.bool_())],
                                             names=[*[batch.schema.names[i] for i in keep], "round_trip"])

    return check


def _shared_model(context: SparkContext, path: str):
    with open(path, "rb") as f:
        proto = f.read(MODEL_BYTES + 1)
    if len(proto) > MODEL_BYTES:
        raise ValueError(f"{path} is larger than {MODEL_BYTES} bytes")
    return context.broadcast(proto)


def _schema(frame: DataFrame, more: str) -> str:
    return "".join(f"`{f.name}` {f.dataType.simpleString()}, " for f in frame.schema) + more


def encode(docs: DataFrame, text: str = "text", *, nbest: int = NBEST, model: str = MODEL) -> DataFrame:
    """``docs`` with ``segmentations``, the ``nbest`` best (score, ids), best first, ``pieces``
    (ids of the best) and ``scores`` (of all). Input columns of these names are replaced."""
    found = F.col("segmentations")
    return segment(docs.drop(*[c for c in ("pieces", "scores") if c != text]), text, nbest=nbest, model=model).withColumns({
        "pieces": F.coalesce(F.get(found, F.lit(0))["ids"], F.array().cast("array<int>")), "scores": found["score"]})


def segment(docs: DataFrame, text: str = "text", *, nbest: int = NBEST, model: str = MODEL, check: bool = False) -> DataFrame:
    """``docs`` with ``segmentations`` alone; ``check`` adds ``round_trip`` in the same pass: whether
    each segmentation decodes to the text."""
    new = ("segmentations", "round_trip") if check else ("segmentations",)
    docs = docs.drop(*[c for c in new if c != text])
    ship_package(docs.sparkSession)
    shared = _shared_model(docs.sparkSession.sparkContext, model)
    more = "segmentations array<struct<score:double,ids:array<int>>>" + (", round_trip boolean" if check else "")
    return docs.withColumn("__text", F.col(text)).mapInArrow(_encode(shared, nbest, check), _schema(docs, more))


def round_trips(segmented: DataFrame, text: str = "text", *, model: str = MODEL) -> DataFrame:
    """``segmented`` with ``round_trip``: whether each of its segmentations decodes to the text."""
    segmented = segmented.drop("round_trip")
    shared = _shared_model(segmented.sparkSession.sparkContext, model)
    return segmented.withColumn("__text", F.col(text)).mapInArrow(
        _check(shared), _schema(segmented, "round_trip boolean"))


def decode(encoded: DataFrame, *, model: str = MODEL) -> DataFrame:
    """``encoded`` with ``decoded``, the text of its ``pieces``."""
    encoded = encoded.drop("decoded")
    shared = _shared_model(encoded.sparkSession.sparkContext, model)
    return encoded.mapInArrow(_decode(shared), _schema(encoded, "decoded string"))
