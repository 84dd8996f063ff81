"""SentencePiece encoding by forward filtering and backward sampling, and lossless decoding.

A text is cut into units, a line feed or blanks with the characters up to the next blank; no piece of the
vocabulary reaches over such a cut, so the piece lattice of a text is the chain of its units' lattices. Per unit,
forward filtering gives every node the total weight of all ways to reach it; backward sampling then draws each
piece from the end with its exact posterior probability. A worker keeps the filtered lattices of the units it
has met as flat arrays and samples all units of a batch at once.

The random number of a draw is a hash of (seed, row key, unit, step), so a row's segmentation is the same on
any cluster and after any retry. A piece weighs exp(-SMOOTH * log(1 + rank)), from its rank in a BPE vocabulary,
or exp(SMOOTH * score) if the model has log-probabilities; a character without a piece is written as its
UTF-8 bytes. Decoding joins the pieces' bytes: the text comes back exactly, also blanks, control characters
and U+2581, which is written as bytes because pieces use it for blanks.

Null and empty texts have no pieces. Null keys count as 0. Repeated rows get the same segmentation.
"""

from __future__ import annotations

import functools
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from costloom.llm.storage import fresh
from costloom.llm.words import mixed

MODEL = "/opt/tokenizers/piece_bpe_32k.model"
SEED = 20
SMOOTH = 1.0
#: Edges of remembered lattices per task; beyond it the memory is filled anew. A matter of speed only.
REMEMBERED = 300_000
#: Probabilities are multiples of 1 / GRID.
GRID = 1 << 30
_SPACE = "▁"
_UNIT = re.compile(r"\n| *[^ \n]+| +")
_STEP, _SPREAD = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xD1B54A32D192ED03)
#: Weight of a character written in bytes.
BYTES = -30.0


@functools.lru_cache(maxsize=2)
def vocabulary(path: str, smooth: float = SMOOTH) -> Vocabulary:
    """A model's vocabulary, read once per worker."""
    return Vocabulary(path, smooth)


class Vocabulary:
    """Pieces of a model: text (blanks as blanks) to id, log weights, and the bytes of every id."""

    def __init__(self, path: str, smooth: float = SMOOTH) -> None:
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        size = model.get_piece_size()
        self.ids: dict[str, int] = {}
        self.bytes: list[bytes] = [b""] * size
        self.byte_ids = np.zeros(256, dtype=np.int64)
        self.weight = np.zeros(size)
        normal = [
            i
            for i in range(size)
            if not (model.is_unknown(i) or model.is_control(i) or model.is_unused(i) or model.is_byte(i))
        ]
        scores = np.array([model.get_score(i) for i in normal])
        ranks = len(scores) > 1 and bool(np.all(scores == np.round(scores))) and scores.min() < -1000
        for i, score in zip(normal, scores, strict=True):
            text = model.id_to_piece(i).replace(_SPACE, " ")
            self.ids[text] = i
            self.bytes[i] = text.encode()
            self.weight[i] = smooth * (-np.log1p(max(0.0, -score)) if ranks else score)
        for i in range(size):
            if model.is_byte(i):
                value = int(model.id_to_piece(i)[1:-1], 16)
                self.byte_ids[value] = i
                self.bytes[i] = bytes([value])
        self.longest = max(map(len, self.ids))
        self._table()

    def _table(self) -> None:
        """Hash table of all pieces and their beginnings: slot to hash, and to the piece or -1."""
        known: dict[int, int] = {}
        for text, i in self.ids.items():
            value = np.zeros(1, dtype=np.uint64)
            for char in text:
                value = value * _STEP + np.uint64(ord(char))
                known.setdefault(int(value[0]), -1)
            known[int(value[0])] = i
        keys = np.array(list(known), dtype=np.uint64)
        self.bits = 18
        slot = (keys * _SPREAD >> np.uint64(64 - self.bits)).astype(np.int64)
        order = np.argsort(slot, kind="stable")
        self.first_at = np.searchsorted(slot[order], np.arange((1 << self.bits) + 1)).astype(np.int32)
        self.keys = np.append(keys[order], np.uint64(0))  # nothing has hash 0
        self.piece_at = np.append(np.array(list(known.values()), dtype=np.int64)[order], -1)

    def find(self, values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Place of each hash in the table, and whether it is there."""
        slot = (values * _SPREAD >> np.uint64(64 - self.bits)).astype(np.int64)
        place = self.first_at[slot]
        found = self.keys[place] == values
        open_ = np.flatnonzero(~found & (self.first_at[slot + 1] - place > 1))
        while len(open_):
            place[open_] += 1
            hit = self.keys[place[open_]] == values[open_]
            found[open_[hit]] = True
            open_ = open_[~hit]
            open_ = open_[self.first_at[slot[open_] + 1] - place[open_] > 1]
        return place, found


class Lattices:
    """Filtered lattices of units as flat arrays.

    The edges into a node lie together, longest piece first, each with the running sum of their posterior
    probabilities in whole numbers of 1 / GRID, its piece, and the place of the first edge into the node it
    comes from (-1 for the start). A draw takes the first edge whose sum exceeds the random number.
    """

    def __init__(self, vocabulary: Vocabulary) -> None:
        self.v = vocabulary
        self.known: dict[str, int] = {}
        self.clear()

    def clear(self) -> None:
        self.known.clear()
        self.size = 0
        self.cum = np.zeros(1 << 18, np.int32)
        self.edge = np.zeros(1 << 18, np.int64)  # place of the next edge, then piece in the low 32 bits

    def _append(self, cum: np.ndarray, edge: np.ndarray) -> None:
        end = self.size + len(cum)
        if end > len(self.cum):
            room = max(2 * len(self.cum), end) - len(self.cum)
            self.cum = np.concatenate([self.cum, np.zeros(room, np.int32)])
            self.edge = np.concatenate([self.edge, np.zeros(room, np.int64)])
        self.cum[self.size : end] = cum
        self.edge[self.size : end] = edge
        self.size = end

    def add(self, units: list[str]) -> None:
        """Filter the lattices of new units, all at once."""
        v = self.v
        sizes = np.fromiter(map(len, units), np.int64, len(units))
        chars = np.frombuffer("".join(units).encode("utf-32-le", "surrogatepass"), dtype=np.uint32).astype(np.uint64)
        first = np.cumsum(sizes) - sizes  # of each unit's characters
        unit = np.repeat(np.arange(len(units)), sizes)
        stop = (first + sizes)[unit]
        # Node of character c's left side: one more node than characters per unit.
        left = np.arange(len(chars)) + unit
        begins, ends, pieces = [], [], []
        at = np.arange(len(chars))
        value = np.zeros(len(chars), dtype=np.uint64)
        for length in range(1, v.longest + 1):
            value = value * _STEP + (chars if length == 1 else chars[at + length - 1])
            place, found = v.find(value)
            piece = v.piece_at[place[found]]
            at, value = at[found], value[found]
            whole = piece >= 0
            begins.append(at[whole])
            ends.append(at[whole] + length)
            pieces.append(piece[whole])
            if length == 1:
                single = np.zeros(len(chars), dtype=bool)
                single[at[whole]] = True
                lone = np.flatnonzero(~single)
                begins.append(lone)
                ends.append(lone + 1)
                pieces.append(-1 - chars[lone].astype(np.int64))
            on = at + length < stop[at]
            at, value = at[on], value[on]
            if not len(at):
                break
        begin, end, piece = np.concatenate(begins), np.concatenate(ends), np.concatenate(pieces)
        source, node = left[begin], left[end - 1] + 1
        weight = np.where(piece >= 0, v.weight[np.maximum(piece, 0)], BYTES)
        depth = end - first[unit[begin]]
        near = (node - source).clip(max=63)
        order = np.argsort((depth << 32) | (node - 1 << 6) | (63 - near), kind="stable")
        source, node, piece, weight, depth = (x[order] for x in (source, node, piece, weight, depth))
        total = np.zeros(len(chars) + len(units))
        share = np.empty(len(node))
        cuts = np.flatnonzero(np.diff(depth, prepend=-1, append=-1))
        for a, b in zip(cuts[:-1].tolist(), cuts[1:].tolist(), strict=True):
            logs = total[source[a:b]] + weight[a:b]
            heads = np.flatnonzero(np.diff(node[a:b], prepend=-1))
            width = np.diff(heads, append=b - a)
            top = np.repeat(np.maximum.reduceat(logs, heads), width)
            parts = np.exp(logs - top)
            mass = np.add.reduceat(parts, heads)
            total[node[a:b][heads]] = top[heads] + np.log(mass)
            share[a:b] = parts / np.repeat(mass, width)
        heads = np.flatnonzero(np.diff(node, prepend=-1))  # edges into a node already lie together
        width = np.diff(heads, append=len(node))
        for k in range(1, int(width.max())):  # within each node alone, so that neighbours change no bit
            here = heads[width > k] + k
            share[here] += share[here - 1]
        cum = (share * GRID).astype(np.int64).clip(max=GRID)
        cum[heads + width - 1] = GRID
        place = np.full(len(chars) + len(units), -1, dtype=np.int64)
        place[node[heads]] = heads + self.size
        self.known.update(zip(units, place[first + sizes + np.arange(len(units))].tolist(), strict=True))
        self._append(cum, (place[source] << 32) | (piece & 0xFFFFFFFF))

    def sample(self, units: list[str], randoms: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Pieces of all units in order, characters in bytes as negative numbers, and the number per unit."""
        if self.size > REMEMBERED:
            self.clear()
        known = self.known
        new = [u for u in set(units) if u not in known]
        at = 0
        while at < len(new):
            upto, size = at, 0
            while upto < len(new) and (upto == at or size + len(new[upto]) <= _NEW):
                size += len(new[upto])
                upto += 1
            self.add(new[at:upto])
            at = upto
        at = np.fromiter(map(known.__getitem__, units), np.int64, len(units))
        who = np.arange(len(units))
        steps: list[tuple[np.ndarray, np.ndarray]] = []
        counts = np.zeros(len(units), dtype=np.int64)
        while len(who):
            u = (mixed(randoms if not steps else randoms[who], 3 + len(steps)) & np.uint64(GRID - 1)).astype(np.int32)
            over = np.flatnonzero(u >= self.cum[at])
            while len(over):
                at[over] += 1
                over = over[u[over] >= self.cum[at[over]]]
            edge = self.edge[at]
            steps.append((who, edge.astype(np.int32)))
            counts[who] += 1
            at = edge >> 32
            on = np.flatnonzero(at >= 0)
            who, at = who[on], at[on]
        ends = np.cumsum(counts)
        out = np.empty(int(ends[-1]) if len(ends) else 0, dtype=np.int64)
        for t, (unit, piece) in enumerate(steps):
            out[ends[unit] - 1 - t] = piece
        return out, counts


def _with_bytes(pieces: np.ndarray, counts: np.ndarray, v: Vocabulary) -> tuple[np.ndarray, np.ndarray]:
    """Replace negative entries by the ids of the character's bytes."""
    odd = np.flatnonzero(pieces < 0)
    if not len(odd):
        return pieces, counts
    coded = [v.byte_ids[list(chr(-1 - p).encode())] for p in pieces[odd].tolist()]
    sizes = np.ones(len(pieces), dtype=np.int64)
    sizes[odd] = [len(c) for c in coded]
    out = np.repeat(pieces, sizes)
    first = np.cumsum(sizes) - sizes
    for at, code in zip(first[odd].tolist(), coded, strict=True):
        out[at : at + len(code)] = code
    owner = np.repeat(np.arange(len(counts)), counts)
    return out, np.bincount(owner, weights=sizes, minlength=len(counts)).astype(np.int64)


#: Characters that are encoded at once.
_BLOCK = 200_000
#: Characters of new units whose lattices are filtered at once.
_NEW = 50_000


def _blocks(texts: pa.Array) -> Iterator[slice]:
    """Runs of texts of about _BLOCK characters."""
    sizes = pa.compute.binary_length(texts).fill_null(0).to_numpy(zero_copy_only=False)
    at = 0
    while at < len(texts):
        upto, size = at, 0
        while upto < len(texts) and (upto == at or size + sizes[upto] <= _BLOCK):
            size += sizes[upto]
            upto += 1
        yield slice(at, upto)
        at = upto


def encode_batch(texts: list[str | None], keys: list[int | None], lattices: Lattices, seed: int) -> list[np.ndarray]:
    """Sampled ids of each text."""
    split = [_UNIT.findall(t or "") for t in texts]
    lengths = np.array([len(s) for s in split], dtype=np.int64)
    units = [u for s in split for u in s]
    key = np.array([k or 0 for k in keys], dtype=np.int64).view(np.uint64)
    place = np.arange(len(units)) - np.repeat(np.cumsum(lengths) - lengths, lengths)
    randoms = mixed(np.repeat(mixed(key, seed), lengths) + place.astype(np.uint64), 1)
    pieces, counts = lattices.sample(units, randoms)
    pieces, counts = _with_bytes(pieces, counts, lattices.v)
    bounds = np.cumsum(counts)
    last = np.concatenate([[0], bounds])[np.cumsum(lengths)]
    return np.split(pieces.astype(np.int32), last[:-1])


def decode_ids(ids: np.ndarray, v: Vocabulary) -> str:
    """The text of a list of ids."""
    return b"".join(map(v.bytes.__getitem__, ids.tolist())).decode("utf-8", "replace")


def encoded(text: Column, key: Column, path: str = MODEL, seed: int = SEED, smooth: float = SMOOTH) -> Column:
    """Sampled ids of a text, and whether decoding them gave the text back."""

    @F.arrow_udf("struct<ids:array<int>,lossless:boolean>")
    def encode(batches: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        lattices = Lattices(vocabulary(path, smooth))  # freed with the task: idle workers stay small
        for texts, keys in batches:
            flat, sizes, same = [np.zeros(0, np.int32)], [0], []
            for part in _blocks(texts):
                values = texts[part].to_pylist()
                found = encode_batch(values, keys[part].to_pylist(), lattices, seed)
                same += [decode_ids(ids, lattices.v) == (t or "") for ids, t in zip(found, values, strict=True)]
                sizes += map(len, found)
                flat += found
            lists = pa.ListArray.from_arrays(pa.array(np.cumsum(sizes), pa.int32()), pa.array(np.concatenate(flat)))
            del flat, texts
            yield pa.StructArray.from_arrays([lists, pa.array(same, pa.bool_())], names=["ids", "lossless"])
            del lists
        pa.default_memory_pool().release_unused()

    return encode(text, key)


def decoded(ids: Column, path: str = MODEL) -> Column:
    """The text of a column of ids; null ids give an empty text."""

    @F.arrow_udf("string")
    def decode(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        v = vocabulary(path)
        for batch in batches:
            yield pa.array([decode_ids(np.array(x or [], dtype=np.int64), v) for x in batch.to_pylist()], pa.string())

    return decode(ids)


def encode_documents(docs: DataFrame, path: str = MODEL, seed: int = SEED, smooth: float = SMOOTH) -> DataFrame:
    """`docs` with ids, n_pieces and lossless in place of text; doc_id is the row key."""
    name = fresh(docs, "_encoded")
    out = docs.withColumn(name, encoded(docs["text"], docs["doc_id"].cast("long"), path, seed, smooth))
    others = [out["`" + c.replace("`", "``") + "`"] for c in docs.columns if c.lower() != "text"]
    ids = F.col(name)["ids"]
    new = [(ids, "ids"), (F.size(ids).cast("long"), "n_pieces"), (F.col(name)["lossless"], "lossless")]
    return out.select(*others, *[c.alias(fresh(docs, n)) for c, n in new])
