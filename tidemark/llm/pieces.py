"""Encoding and decoding with a SentencePiece BPE model.

An encoding is a row of pieces whose neighbours are *compatible*: the two joined and encoded
alone give the two again. So every prefix of a text has one last piece, which follows from
shorter prefixes: it ends the prefix, and it is compatible with the last piece of what comes
before it. An automaton names the pieces that end at each place; the table of last pieces is
filled from the left, and the ids are read off it from the right.

Two neighbouring characters that no piece holds side by side are never merged. Texts are cut
there into segments. The different segments of many texts go through the automaton together,
one place at a time, as numpy arrays.
"""

from __future__ import annotations

import codecs
import sys
import types

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import LONGEST_RUN, different_runs, mix, spread, table

#: SentencePiece's mark for a blank.
SPACE = "▁"
#: What SentencePiece decodes the unknown piece to.
UNKNOWN = " ⁇ "
#: Characters handled at a time; bounds the memory of a task whatever the length of its texts.
CHARACTERS = 1 << 22
#: Segments longer than this are encoded one by one.
LONG = LONGEST_RUN
#: Pairs of pieces whose compatibility a worker remembers, a power of two.
REMEMBERED = 1 << 21

_U64 = np.uint64
_BASE = _U64(0x9E3779B97F4A7C15)
_OVER = -np.inf


def model_path(name: str = "piece_bpe_32k.model") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def _slots(keys: np.ndarray, bits: int) -> np.ndarray:
    return ((keys.astype(_U64) * _BASE) >> _U64(64 - bits)).astype(np.int64)


class _Lookup:
    """A fixed map from integers of 0 or more, for whole arrays of keys."""

    def __init__(self, found: dict, missing, kind):
        keys = np.fromiter(found.keys(), np.int64, len(found))
        values = np.fromiter(found.values(), kind, len(found))
        self.bits = max(8, (len(keys) * 4).bit_length())
        self.keys = np.full(1 << self.bits, -1, np.int64)
        self.values = np.full(1 << self.bits, missing, kind)
        left, slot = np.arange(len(keys)), _slots(keys, self.bits)
        while len(left):
            free = np.flatnonzero(self.keys[slot] < 0)
            taken, first = np.unique(slot[free], return_index=True)
            own = free[first]
            self.keys[taken], self.values[taken] = keys[left[own]], values[left[own]]
            left, slot = np.delete(left, own), np.delete(slot, own)
            slot = (slot + 1) & ((1 << self.bits) - 1)

    def __call__(self, keys: np.ndarray) -> np.ndarray:
        slot = _slots(keys, self.bits)
        held, found = self.keys[slot], self.values[slot]
        again = np.flatnonzero((held != keys) & (held >= 0))
        while len(again):
            slot[again] = (slot[again] + 1) & ((1 << self.bits) - 1)
            held, found[again] = self.keys[slot[again]], self.values[slot[again]]
            again = again[(held != keys[again]) & (held >= 0)]
        return found


class PieceModel:
    """The pieces of a BPE model with byte fallback, and what follows from them.

    Models that change texts before they are cut, other than by a leading blank and the
    mark for blanks, are refused.
    """

    def __init__(self, path: str):
        from sentencepiece import SentencePieceProcessor

        model = SentencePieceProcessor(model_file=path)
        if model.normalize("  ﬁ　a ") != "▁▁▁ﬁ　a▁":
            raise ValueError("The model normalises texts")
        self.count = model.get_piece_size()
        self.surface, self.score, self.bytes = [], {}, [0] * 256
        for i in range(self.count):
            piece = model.id_to_piece(i)
            if model.is_byte(i):
                self.bytes[int(piece[3:5], 16)] = i
                self.surface.append(bytes([int(piece[3:5], 16)]))
            elif model.is_control(i):
                self.surface.append(b"")
            elif model.is_unknown(i):
                self.surface.append(UNKNOWN.encode())
            else:
                self.surface.append(piece.replace(SPACE, " ").encode())
                if not model.is_unused(i):
                    self.score[piece] = (model.get_score(i), i)
        self.control = {i for i in range(self.count) if model.is_control(i)}
        self.spaced = {i for p, (_, i) in self.score.items() if p[0] == SPACE}
        characters = sorted({c for piece in self.score for c in piece})
        # Characters that are no pieces of their own get numbers above all ids.
        self.ids = {piece: i for piece, (_, i) in self.score.items()}
        self.loose = [c for c in characters if c not in self.ids]
        self.ids |= {c: self.count + k for k, c in enumerate(self.loose)}
        self.kind = np.zeros(0x110000, np.uint16)
        self.kind[[ord(c) for c in characters]] = np.arange(1, len(characters) + 1)
        self.kinds = len(characters) + 1
        self.beside = np.zeros((self.kinds, self.kinds), bool)
        self._split()
        self._automaton()
        self.known = np.full(REMEMBERED, -1, np.int64)
        self.verdict = np.zeros(REMEMBERED, bool)
        self.single: dict[tuple[int, int], bool] = {}

    def _merges(self, piece: str) -> list[tuple[float, str, str]] | None:
        """The merges that make up a piece: score, and first and last symbol afterwards."""
        parts, steps = list(piece), []
        while len(parts) > 1:
            scored = [
                (self.score[a + b][0], -i)
                for i, (a, b) in enumerate(zip(parts, parts[1:], strict=False))
                if a + b in self.score
            ]
            if not scored:
                return None  # not what the piece's own text is encoded to
            score, at = max(scored)
            parts[-at : 2 - at] = [parts[-at] + parts[1 - at]]
            steps.append((score, parts[0], parts[-1]))
        return steps

    def _split(self) -> None:
        """Which symbols merge, and in which order the merges of each piece happen."""
        symbols, pairs = self.count + len(self.loose), {}
        made = {piece: self._merges(piece) for piece in self.ids}
        self.reached = {self.ids[piece] for piece, steps in made.items() if steps is not None}
        turns = 1 + max(len(steps or ()) for steps in made.values())
        self.turn = np.full((symbols, turns), _OVER)
        self.left = np.zeros((symbols, turns), np.int64)
        self.right = np.zeros((symbols, turns), np.int64)
        self.size = np.zeros(symbols, np.int64)
        for piece, i in self.ids.items():
            self.size[i] = len(piece)
            self.left[i, 0], self.right[i, 0] = self.ids[piece[0]], self.ids[piece[-1]]
            for k, (score, first, last) in enumerate(made[piece] or ()):
                self.turn[i, k] = score
                self.left[i, k + 1], self.right[i, k + 1] = self.ids[first], self.ids[last]
            for k in range(1, len(piece)):
                a, b = piece[:k], piece[k:]
                self.beside[self.kind[ord(a[-1])], self.kind[ord(b[0])]] = True
                if a in self.ids and b in self.ids:
                    pairs[self.ids[a] * symbols + self.ids[b]] = self.score[piece][0]
        self.symbols = symbols
        self.merged = _Lookup(pairs, _OVER, np.float64)

    def _automaton(self) -> None:
        """A trie of the pieces; ``fail`` leads to the longest proper suffix in it.

        ``match`` is the longest suffix of a state that is a piece, ``after`` the next one.
        """
        kind = {c: int(self.kind[ord(c)]) for piece in self.ids for c in piece}
        step: dict[int, int] = {}
        below: list[list[tuple[int, int]]] = [[]]
        token = [-1]
        for piece, i in self.ids.items():
            state = 0
            for c in piece:
                key = state << 16 | kind[c]
                if key not in step:
                    step[key] = len(token)
                    below[state].append((kind[c], len(token)))
                    below.append([])
                    token.append(-1)
                state = step[key]
            if i in self.reached:
                token[state] = i
        fail, match, after = [0] * len(token), [0] * len(token), [0] * len(token)
        level = [0]
        while level:
            following = []
            for state in level:
                for c, child in below[state]:
                    back = fail[state]
                    while back and back << 16 | c not in step:
                        back = fail[back]
                    fail[child] = step.get(back << 16 | c, 0) if state else 0
                    after[child] = match[fail[child]]
                    match[child] = child if token[child] >= 0 else after[child]
                    following.append(child)
            level = following
        self.step, self.fail, self.match, self.after, self.token = step, fail, match, after, token
        self.steps = _Lookup(step, 0, np.int64)
        self.arrays = [np.array(x, np.int64) for x in (fail, match, after, token)]

    def _tested(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Whether ``a`` beside ``b`` stay apart: runs the merges of both, best first.

        They don't where the symbols that touch would merge before either side goes on.
        """
        apart, open_ = np.ones(len(a), bool), np.arange(len(a))
        i, j = np.zeros(len(a), np.int64), np.zeros(len(a), np.int64)
        while len(open_):
            first, second = self.turn[a, i], self.turn[b, j]
            across = self.merged(self.right[a, i] * self.symbols + self.left[b, j])
            # Equal scores go by place: left of the border, across it, right of it.
            joined = (across > first) & (across >= second)
            apart[open_[joined]] = False
            go = ~joined & ((first > _OVER) | (second > _OVER))
            lead = first >= second
            i, j = (i + lead)[go], (j + ~lead)[go]
            a, b, open_ = a[go], b[go], open_[go]
        return apart

    def compatible(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        key = a * self.symbols + b
        slot = _slots(key, REMEMBERED.bit_length() - 1)
        apart = self.verdict[slot]
        new = np.flatnonzero(self.known[slot] != key)
        if len(new):
            _, first, back = np.unique(key[new], return_index=True, return_inverse=True)
            tested = self._tested(a[new[first]], b[new[first]])
            apart[new] = tested[back]
            at = slot[new[first]]
            # Two new pairs may share a slot; a pair and its verdict are written alike.
            at, last = np.unique(at, return_index=True)
            self.known[at], self.verdict[at] = key[new[first]][last], tested[last]
        return apart

    def _together(self, kinds: np.ndarray, start: np.ndarray, size: np.ndarray):
        """Pieces of segments, longest segment first: all pieces, and their number by segment."""
        fail, match, after, token = self.arrays
        waiting = np.searchsorted(-size, -np.arange(int(size[0]) if len(size) else 0), "left")
        begin = np.concatenate([[0], np.cumsum(waiting)])
        last = np.zeros(begin[-1], np.int64)
        state = np.zeros(len(size), np.int64)
        for i, n in enumerate(waiting):
            c = kinds[start[:n] + i].astype(np.int64)
            from_, state = state[:n], np.zeros(n, np.int64)
            open_ = np.arange(n)
            while len(open_):
                state[open_] = self.steps(from_[open_] << 16 | c[open_])
                open_ = open_[(state[open_] == 0) & (from_[open_] != 0)]
                from_[open_] = fail[from_[open_]]
            open_, at = np.arange(n), match[state]
            while len(open_):
                piece = token[at]
                before = i - self.size[piece]
                fits = before < 0
                rest = np.flatnonzero(~fits)
                previous = last[begin[before[rest]] + open_[rest]]
                fits[rest] = self.compatible(previous, piece[rest])
                last[begin[i] + open_[fits]] = piece[fits]
                open_, at = open_[~fits], after[at[~fits]]
        rounds, open_, place = [], np.arange(len(size)), size - 1
        count = np.zeros(len(size), np.int64)
        while len(open_):
            piece = last[begin[place] + open_]
            rounds.append((open_, piece))
            count[open_] += 1
            place = place - self.size[piece]
            open_, place = open_[place >= 0], place[place >= 0]
        found = np.zeros(int(count.sum()), np.int64)
        ends = np.cumsum(count) - 1
        for k, (segment, piece) in enumerate(rounds):
            found[ends[segment] - k] = piece
        return found, count

    def _alone(self, kinds: np.ndarray) -> list[int]:
        """The pieces of one long segment."""
        state, last, kinds = 0, [], kinds.tolist()
        for i, c in enumerate(kinds):
            while state and state << 16 | c not in self.step:
                state = self.fail[state]
            state = self.step.get(state << 16 | c, 0)
            at = self.match[state]
            while True:
                piece = self.token[at]
                before = i - int(self.size[piece])
                if before < 0 or self._beside(last[before], piece):
                    break
                at = self.after[at]
            last.append(piece)
        found, at = [], len(kinds) - 1
        while at >= 0:
            found.append(last[at])
            at -= int(self.size[last[at]])
        return found[::-1]

    def _beside(self, a: int, b: int) -> bool:
        known = self.single.get((a, b))
        if known is None:
            if len(self.single) >= REMEMBERED // 8:
                self.single.clear()
            known = self.single[a, b] = bool(self._tested(np.array([a]), np.array([b]))[0])
        return known

    def _bytes_of(self, code: int) -> list[int]:
        return [self.bytes[b] for b in chr(code).encode()]

    def _run(self, codes: np.ndarray, kinds: np.ndarray, cut: np.ndarray):
        """Ids of characters that are cut before each place of ``cut``, and their number by segment."""
        size = np.diff(cut, append=len(codes))
        long = np.flatnonzero(size > LONG)
        short = np.flatnonzero(size <= LONG)
        # Short segments: gathered, made different, and encoded longest first.
        flat = np.repeat(size <= LONG, size)
        s_codes, s_kinds, s_size = codes[flat], kinds[flat], size[short]
        s_start = np.cumsum(s_size) - s_size
        letters = mix(s_codes.astype(_U64) + _U64(1))
        first, which = different_runs(s_codes, letters, s_start, s_size)
        d_start, d_size = s_start[first], s_size[first]
        known = (d_size > 1) | (s_kinds[d_start] > 0)
        order = np.flatnonzero(known)
        order = order[np.argsort(-d_size[order], kind="stable")]
        pieces, count = self._together(s_kinds, d_start[order], d_size[order])
        # Each different segment's ids, one after another; unknown characters by their bytes.
        total = np.zeros(len(d_size) + len(long), np.int64)
        total[order] = count
        fallback = [(d, self._bytes_of(int(s_codes[d_start[d]]))) for d in np.flatnonzero(~known)]
        fallback += [
            (len(d_size) + k, self._alone(kinds[cut[s] : cut[s] + size[s]]))
            for k, s in enumerate(long)
        ]
        for d, own in fallback:
            total[d] = len(own)
        ends = np.cumsum(total)
        ids = np.zeros(int(ends[-1]) if len(ends) else 0, np.int64)
        ids[spread((ends - total)[order], count)] = pieces
        for d, own in fallback:
            ids[ends[d] - total[d] : ends[d]] = own
        segment = np.zeros(len(cut), np.int64)
        segment[short], segment[long] = which, len(d_size) + np.arange(len(long))
        count = total[segment]
        ids = ids[spread((ends - total)[segment], count)]
        if self.loose and len(ids):
            own = [self._bytes_of(ord(c)) for c in self.loose]
            width = np.array([*[1] * self.count, *map(len, own)], np.int64)[ids]
            count = np.add.reduceat(width, np.cumsum(count) - count)
            at = np.flatnonzero(ids >= self.count)
            whole = np.repeat(ids, width)
            whole[spread((np.cumsum(width) - width)[at], width[at])] = [
                b for i in ids[at] for b in own[i - self.count]
            ]
            ids = whole
        return ids, count

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts, one after another, and their number by text."""
        marked = [SPACE + text.replace(" ", SPACE) if text else "" for text in texts]
        bounds = np.cumsum([0, *map(len, marked)])
        whole, parts, counts = "".join(marked), [], np.zeros(len(texts), np.int64)
        begin, window = 0, CHARACTERS
        while begin < len(whole):
            end = min(begin + window, len(whole))
            codes = np.frombuffer(whole[begin:end].encode("utf-32-le"), np.uint32)
            kinds = self.kind[codes]
            cuts = np.ones(len(codes), bool)
            pair = kinds[:-1].astype(np.int64) * self.kinds + kinds[1:]
            cuts[1:] = ~self.beside.ravel()[pair]
            cuts[bounds[(bounds >= begin) & (bounds < end)] - begin] = True
            cut = np.flatnonzero(cuts)
            if end < len(whole):
                if len(cut) == 1:  # no end of the segment in sight
                    window *= 2
                    continue
                end, cut = begin + int(cut[-1]), cut[:-1]
                codes, kinds = codes[: end - begin], kinds[: end - begin]
            ids, count = self._run(codes, kinds, cut)
            parts.append(ids.astype(np.int32))
            np.add.at(counts, np.searchsorted(bounds, begin + cut, "right") - 1, count)
            begin, window = end, CHARACTERS
        return np.concatenate(parts or [np.zeros(0, np.int32)]), counts

    def decode(self, ids: list[int]) -> str:
        """The text of some ids; a byte that is part of no character becomes U+FFFD."""
        if not self.control.isdisjoint(ids):
            # Control pieces have no text, but bytes on their two sides make no character.
            runs = [[]]
            for i in ids:
                if i in self.control:
                    runs.append([])
                else:
                    runs[-1].append(i)
            runs = [run for run in runs if run]
            # Only the first run follows the leading blank that encoding adds.
            return "".join(self._plain(run, k == 0) for k, run in enumerate(runs))
        return self._plain(ids, True)

    def _plain(self, ids: list[int], leading: bool) -> str:
        data = b"".join(map(self.surface.__getitem__, ids))
        if leading and len(ids) and ids[0] in self.spaced:
            data = data[1:]
        return data.decode("utf-8", "tidemark-bytewise")


codecs.register_error("tidemark-bytewise", lambda error: ("\ufffd", error.start + 1))


def _model(path: str) -> PieceModel:
    """The worker's model; it outlives the task."""
    held = sys.modules.setdefault("_tidemark_pieces", types.ModuleType("_tidemark_pieces"))
    if getattr(held, "path", None) != path:
        held.path, held.model = path, PieceModel(path)
    return held.model


def _groups(batch: pa.RecordBatch, column: str, size) -> list[pa.RecordBatch]:
    """The batch in slices of about ``CHARACTERS``, or of one row that holds more."""
    sizes = np.asarray(size(batch.column(column)).fill_null(0), np.int64)
    ends, begin, slices = np.cumsum(sizes), 0, []
    while begin < len(sizes):
        full = int(np.searchsorted(ends, ends[begin] - sizes[begin] + CHARACTERS, "right"))
        end = max(begin + 1, full)
        slices.append(batch.slice(begin, end - begin))
        begin = end
    return slices


def _ids_of(model: PieceModel, texts: list[str | None]) -> pa.Array:
    ids, counts = model.encode([text or "" for text in texts])
    ends = pa.array(np.concatenate([[0], np.cumsum(counts)]), pa.int32())
    return pa.ListArray.from_arrays(ends, pa.array(ids))


def _texts_of(model: PieceModel, ids: pa.Array) -> pa.Array:
    return pa.array([model.decode(row or []) for row in ids.to_pylist()], pa.string())


def encoded(docs: DataFrame, path: str | None = None) -> DataFrame:
    """``doc_id, ids``: the ids of every text, without begin and end ids.

    Reads ``doc_id`` (of any type) and ``text``; other columns are not looked at, whatever
    their names. Null and empty texts have no ids. Rows are independent: repeated rows and
    null ids come back as they are, an empty table gives an empty result. A text longer than
    ``CHARACTERS`` is handled in parts; its ids are one row.
    """
    path = path or model_path()

    def encode(batches):
        model = _model(path)
        for batch in batches:
            for part in _groups(batch, "text", pc.binary_length):
                ids = _ids_of(model, part.column("text").to_pylist())
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), ids], ["doc_id", "ids"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(encode, f"doc_id {kind}, ids array<int>")


def decoded(rows: DataFrame, path: str | None = None) -> DataFrame:
    """``doc_id, decoded``: the texts of ``ids``. Null ids give an empty text.

    Treats other columns, repeated rows and empty tables like :func:`encoded`.
    """
    path = path or model_path()

    def decode(batches):
        model = _model(path)
        for batch in batches:
            for part in _groups(batch, "ids", pc.list_value_length):
                texts = _texts_of(model, part.column("ids"))
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), texts], ["doc_id", "decoded"]
                )

    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.select("doc_id", "ids").mapInArrow(decode, f"doc_id {kind}, decoded string")


def round_trip(docs: DataFrame, path: str | None = None) -> DataFrame:
    """``doc_id, ids, decoded``: :func:`encoded` and :func:`decoded` in one pass over the texts."""
    path = path or model_path()

    def both(batches):
        model = _model(path)
        for batch in batches:
            for part in _groups(batch, "text", pc.binary_length):
                ids = _ids_of(model, part.column("text").to_pylist())
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), ids, _texts_of(model, ids)],
                    ["doc_id", "ids", "decoded"],
                )

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(
        both, f"doc_id {kind}, ids array<int>, decoded string"
    )


def op13_pieces(spark, sf_dir: str) -> DataFrame:
    """Digests of every document's ids and of the text that they decode to."""
    return round_trip(table(spark, sf_dir, "documents")).select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.concat_ws(",", F.col("ids").cast("array<string>")), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )
