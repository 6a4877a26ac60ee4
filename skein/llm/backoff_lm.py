"""Language-model scores from a weighted backoff automaton.

Training texts give the counts of all tokens, 2-grams and 3-grams: every n-gram counts, however
rare, so the model grows with the corpus. The smoothed model:

* a token known from training has (c - D) / N, all unknown tokens share D * V / N (absolute
  discounting, D from the numbers of tokens seen once and twice);
* after a history h that was seen, p(w | h) = (c(h w) + M * p(w | shorter h)) / (c(h) + M) with M
  from ``MASS`` (Dirichlet smoothing). All that follows h is counted, so each state's
  probabilities sum to one.

Histories become states and n-grams arcs; what was not seen after a history takes its failure arc,
of weight M / (c(h) + M), to the shorter one. A text is scored in one traversal from left to right
that carries the state and adds log10 probabilities.

Size. The counts never pass the driver and are never shipped whole. Documents are dealt into
blocks of about 16 MB (by the row alone, so copies spread). A block asks for the counts of its own
distinct n-grams: sorted keys, cut into parts of the key space, one row a part. Each part adds up
what the blocks sent (a hot n-gram is one key a block) and answers every row with the totals in
the order of its keys. The block then builds the states and arcs that its texts can meet; all
others have no bearing on them. A part holds about what a block sends.

Keys are hashes: 63 bits for tokens, 55 for n-grams. Among 10^8 distinct tokens any two share a key
with a probability of 0.0005; tokens or n-grams that do so add up their counts.

Null and empty texts consist of the end token; a text of any length is one row of one block, whose
traversal is cut into lanes. Without any training token all scores are 0. A null doc_id is held
out by the checksum of an empty text; repeated rows are scored each.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from skein.llm.common import BLOCK_BYTES, give_back, utf8

#: Weight, in tokens, of the shorter history's probability beside a history of one and of two tokens.
MASS = (200.0, 20.0)
#: Tokens of a text that are traversed in one go.
LANE = 1024
#: Bytes of text that are hashed at once.
WINDOW = 1 << 20
#: Key of the end token; the lowest bit of all keys is 0.
END = np.uint64(2)

_U = np.uint64
_EVEN = np.uint64((1 << 64) - 2)
_SPACE = np.zeros(256, dtype=bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_ODD = 0x9E3779B97F4A7C15


def _mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> _U(33))) * _U(0xFF51AFD7ED558CCD)
    h = (h ^ (h >> _U(33))) * _U(0xC4CEB9FE1A85EC53)
    return h ^ (h >> _U(33))


_BYTE = _mixed(np.arange(1, 257, dtype=np.uint64) * _U(_ODD))


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, dtype=np.uint64)
    out[0] = 1
    return np.cumprod(out, dtype=np.uint64)


class Hasher:
    """Keys of words: a polynomial over the bytes, taken from running sums, so that a window of
    text costs a few array operations."""

    def __init__(self):
        self.up = self.down = np.zeros(0, dtype=np.uint64)

    def words(self, data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(key, first byte) of each word of ``data``, which begins and ends with white space."""
        space = _SPACE[data]
        edges = np.flatnonzero(space[1:] != space[:-1]) + 1
        first, last = edges[0::2], edges[1::2]
        keys = np.empty(len(first), dtype=np.uint64)
        at = 0
        while at < len(first):
            to = max(at + 1, int(np.searchsorted(last, first[at] + WINDOW)))  # a longer word is a window alone
            low, high = int(first[at]), int(last[to - 1])
            if high - low > len(self.up):
                n = max(WINDOW, high - low)
                self.up, self.down = _powers(_ODD, n), _powers(pow(_ODD, -1, 1 << 64), n)
            sums = np.concatenate([[_U(0)], np.cumsum(_BYTE[data[low:high]] * self.up[: high - low], dtype=np.uint64)])
            a, b = first[at:to] - low, last[at:to] - low
            keys[at:to] = _mixed((sums[b] - sums[a]) * self.down[a]) & _EVEN
            at = to
        return keys, first

    def texts(self, values: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """(keys of all tokens, tokens per text); each text's last token is the end."""
        ends = np.cumsum([len(v) for v in values])
        cuts = [0, *(np.flatnonzero(np.diff(ends // (2 * WINDOW))) + 1).tolist(), len(values)]
        slices = [self._slice(values[a:b]) for a, b in zip(cuts, cuts[1:])]
        return np.concatenate([t for t, _ in slices]), np.concatenate([n for _, n in slices])

    def _slice(self, values: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        data = np.frombuffer(b" " + b"".join(v.lower() + b" " for v in values), dtype=np.uint8)
        keys, first = self.words(data)
        ends = np.cumsum([len(v) + 1 for v in values]) if values else np.zeros(0, np.int64)
        upto = np.searchsorted(first, ends, side="right")
        sizes = np.diff(upto, prepend=0)
        tokens = np.full(len(keys) + len(values), END)
        tokens[np.arange(len(keys)) + np.repeat(np.arange(len(values)), sizes)] = keys
        return tokens, sizes + 1


def ngram_keys(tokens: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Keys of the 2-gram and the 3-gram that end at each token, 0 where the text is shorter."""
    two, three = np.zeros_like(tokens), np.zeros_like(tokens)
    two[1:] = np.maximum(_mixed(tokens[:-1] * _U(0xD6E8FEB86659FD93) + tokens[1:]) >> _U(8) & _EVEN, END)
    three[1:] = np.maximum(_mixed(two[:-1] * _U(0xA0761D6478BD642F) + tokens[1:]) >> _U(8) & _EVEN, END)
    first = np.cumsum(sizes) - sizes
    two[first] = three[first] = 0
    three[(first + 1)[sizes > 1]] = 0
    return two, three


#: Bits of the keys of each order.
BITS = {1: 64, 2: 56, 3: 56}
ASKS = "block long, ord int, part int, n int, keys binary, counts binary"
TOLD = "block long, ord int, part int, n int, totals binary"


def packed(values: np.ndarray) -> bytes:
    """Unsigned integers in the fewest bytes each, all first bytes before all second ones (small values
    leave runs of zeros), compressed."""
    top = int(values.max()) if len(values) else 0
    width = max(1, (top.bit_length() + 7) // 8)
    planes = np.ascontiguousarray(values.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :width].T)
    return bytes([width]) + pa.compress(planes.tobytes(), codec="zstd", asbytes=True)


def unpacked(data: bytes, n: int) -> np.ndarray:
    raw = pa.decompress(data[1:], decompressed_size=n * data[0], codec="zstd", asbytes=True)
    wide = np.zeros((n, 8), dtype=np.uint8)
    wide[:, : data[0]] = np.frombuffer(raw, dtype=np.uint8).reshape(data[0], n).T
    return wide.view("<u8")[:, 0]


def steps(keys: np.ndarray) -> bytes:
    """Sorted keys as the first one and the differences."""
    return keys[:1].astype("<u8").tobytes() + packed(np.diff(keys))


def unsteps(data: bytes, n: int) -> np.ndarray:
    out = np.empty(n, dtype=np.uint64)
    out[0] = np.frombuffer(data[:8], dtype="<u8")[0]
    out[1:] = unpacked(data[8:], n - 1)
    return np.cumsum(out, dtype=np.uint64)


def distinct(keys: np.ndarray, train: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(distinct keys, sorted; count of each among ``train``); key 0 is none."""
    marked = np.sort(keys | train.astype(np.uint64))
    marked = marked[np.searchsorted(marked, END):]
    if not len(marked):
        return marked, np.zeros(0, np.int64)
    plain = marked & _EVEN
    start = np.concatenate([[0], np.flatnonzero(plain[1:] != plain[:-1]) + 1])
    return plain[start], np.add.reduceat((marked & _U(1)).astype(np.int64), start)


def asks(block: int, order: int, keys: np.ndarray, counts: np.ndarray, parts: int) -> list[tuple]:
    """Rows of one block and order: its keys cut into the parts of the key space."""
    if not len(keys):
        return []
    top = keys >> _U(BITS[order] - 32)
    part = ((top * _U(parts)) >> _U(32)).astype(np.int64)
    cut = np.flatnonzero(np.diff(part)) + 1
    rows = []
    for a, b in zip([0, *cut.tolist()], [*cut.tolist(), len(keys)]):
        rows.append((block, order, int(part[a]), b - a, steps(keys[a:b]), packed(counts[a:b])))
    return rows


def _table(rows: list[tuple], schema: str) -> pa.Table:
    kinds = {"long": pa.int64(), "int": pa.int32(), "binary": pa.binary()}
    fields = [f.split() for f in schema.split(", ")]
    return pa.table({name: pa.array([r[i] for r in rows], kinds[kind]) for i, (name, kind) in enumerate(fields)})


def numbered(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(distinct keys, sorted; a place of each; the number of the key at each place)."""
    order = np.argsort(keys).astype(np.int32 if len(keys) < 1 << 31 else np.int64)
    ranked = keys[order]
    new = np.ones(len(keys), dtype=bool)
    new[1:] = ranked[1:] != ranked[:-1]
    number = np.empty(len(keys), dtype=order.dtype)
    number[order] = np.cumsum(new, dtype=order.dtype) - 1
    return ranked[new], order[new], number


def key_rows(rows: list[tuple]) -> pa.RecordBatch:
    """Rows of ``asks`` as one batch."""
    return _table(rows, ASKS).combine_chunks().to_batches()[0]


def add_up(asked: pa.Table, with_keys: bool = False) -> tuple[np.ndarray, ...]:
    """(totals of the distinct keys of a part, place of each asked key, rows' ends); ``with_keys``:
    (the distinct keys, their totals)."""
    n = asked.column("n").to_pylist()
    keys = np.concatenate([unsteps(k, m) for k, m in zip(asked.column("keys").to_pylist(), n)])
    counts = np.concatenate([unpacked(c, m) for c, m in zip(asked.column("counts").to_pylist(), n)])
    every, _, place = numbered(keys)
    totals = np.bincount(place, weights=counts, minlength=len(every)).astype(np.int64)
    return (every, totals) if with_keys else (totals, place, np.cumsum(n))


def answer(asked: pa.Table) -> pa.Table:
    """The totals of a part for each row that asks."""
    if not asked.num_rows:
        return _table([], TOLD)
    totals, place, ends = add_up(asked)
    pieces = np.split(totals[place], ends[:-1])
    heads = zip(*(asked.column(c).to_pylist() for c in ("block", "ord", "part", "n")))
    return _table([(*head, packed(x)) for head, x in zip(heads, pieces)], TOLD)


def statistics(texts: DataFrame, parts: int) -> list[int]:
    """Tokens, distinct tokens, tokens seen once, seen twice, over the column ``text``."""

    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher, held, size = Hasher(), [], 0

        def emit() -> pa.RecordBatch:
            keys, c = np.unique(np.concatenate(held), return_counts=True)
            return key_rows(asks(0, 1, keys, c, parts))

        for b in batches:
            for at in range(0, b.num_rows, 512):
                tokens, _ = hasher.texts(utf8(b.column(0).slice(at, 512)))
                held.append(tokens)
                size += len(tokens)
                if size >= 4_000_000:
                    yield emit()
                    held, size = [], 0
        if size:
            yield emit()
        give_back()

    def count(asked: pa.Table) -> pa.Table:
        totals = add_up(asked)[0] if asked.num_rows else np.zeros(0, np.int64)
        x = [int(totals.sum()), len(totals), int((totals == 1).sum()), int((totals == 2).sum())]
        return pa.table({k: pa.array([v], pa.int64()) for k, v in zip("nvot", x)})

    told = texts.mapInArrow(ask, ASKS).groupBy("part").applyInArrow(count, "n long, v long, o long, t long")
    return [int(x or 0) for x in told.agg(*[F.sum(c) for c in "nvot"]).first()]


class Numbered:
    """Tokens and n-grams of a block of texts, numbered in the order of their keys: ``n`` distinct ones,
    ``first`` token at which each ends, ``place`` with the number of that which ends at a token (n where
    there is none)."""

    def __init__(self, values: list[bytes]):
        tokens, self.sizes = Hasher().texts(values)
        self.n, self.place, self.first = {}, {}, {}
        for order, keys in enumerate((tokens, *ngram_keys(tokens, self.sizes)), 1):
            every, first, place = numbered(keys)
            if order > 1 and len(every) and every[0] == 0:
                every, first, place = every[1:], first[1:], place - 1
                place[place < 0] = len(every)
            self.n[order], self.first[order], self.place[order] = len(every), first, place


class Automaton:
    """The states and arcs that a block's texts can meet.

    State 0 is the empty history, 1 + i the token i, then the 2-grams. Each n-gram that was seen in
    training is an arc from the state of its history; arcs are found by the n-gram's number and
    taken only from their own state.
    """

    def __init__(self, x: Numbered, counts: dict[int, np.ndarray], own: np.ndarray, mass: tuple[float, float]):
        """``own``: probability of each token out of context."""
        n1, n2 = x.n[1], x.n[2]
        c1, c2, c3 = (counts[i].astype(np.float64) for i in (1, 2, 3))
        at2, at3 = x.first[2], x.first[3]
        v, w = x.place[1][at2 - 1], x.place[1][at2]
        history, tail = x.place[2][at3 - 1], x.place[2][at3]
        p2 = (c2 + mass[0] * own[w]) / (c1[v] + mass[0])
        p3 = (c3 + mass[1] * np.where(c2[tail] > 0, p2[tail], 0.0)) / (c2[history] + mass[1])  # c3 > 0 needs c2 > 0
        x.first.clear()
        # per order: the state an arc leaves (-1: no such arc), its weight, the state it leads to
        small, none = np.int32 if n1 + n2 < 1 << 30 else np.int64, np.array([-1])
        self.leaves = {2: np.concatenate([np.where(c2 > 0, 1 + v, -1), none]).astype(small),
                       3: np.concatenate([np.where(c3 > 0, 1 + n1 + history, -1), none]).astype(small)}
        self.arc = {1: np.log10(own), 2: np.append(np.log10(np.maximum(p2, 1e-300)), 0.0), 3: np.append(np.log10(np.maximum(p3, 1e-300)), 0.0)}
        self.to = {1: np.where(c1 > 0, 1 + np.arange(n1), 0).astype(small), 2: np.append(1 + n1 + np.arange(n2), 0).astype(small),
                   3: np.append(1 + n1 + tail, 0).astype(small)}
        self.fail = np.concatenate([[0], np.zeros(n1, small), 1 + w]).astype(small)
        self.weight = np.concatenate([[0.0], np.log10(mass[0] / (c1 + mass[0])), np.log10(mass[1] / (c2 + mass[1]))])
        self.pairs = 1 + n1  # the first state of two tokens

    def score(self, x: Numbered) -> np.ndarray:
        """log10 probability of each text. Texts are traversed side by side, long ones in lanes: two
        tokens fix the state, so a lane carries its state on from two tokens before its own."""
        sizes = x.sizes
        lanes = -(-sizes // LANE)
        text = np.repeat(np.arange(len(sizes)), lanes)
        nth = np.arange(len(text)) - np.repeat(np.cumsum(lanes) - lanes, lanes)
        ends = np.cumsum(sizes)
        warm = np.where(nth > 0, 2, 0)
        begin = (ends - sizes)[text] + nth * LANE - warm
        length = np.minimum(begin + warm + LANE, ends[text]) - begin
        order = np.argsort(-length, kind="stable")
        begin, warm, length = begin[order], warm[order], length[order]
        state, total = np.zeros(len(text), np.int64), np.zeros(len(text))
        active = np.searchsorted(-length, -np.arange(int(length[0]) if len(length) else 0), side="left")
        for j, k in enumerate(active.tolist()):
            at, s = begin[:k] + j, state[:k]
            i1, i2, i3 = (x.place[o][at] for o in (1, 2, 3))
            three = self.leaves[3][i3] == s
            back = ~three & (s >= self.pairs)  # a failure arc from two tokens to one
            p = np.where(three, self.arc[3][i3], np.where(back, self.weight[s], 0.0))
            s = np.where(back, self.fail[s], s)
            two = ~three & (self.leaves[2][i2] == s)
            p += np.where(three, 0.0, np.where(two, self.arc[2][i2], self.weight[s] + self.arc[1][i1]))
            state[:k] = np.where(three, self.to[3][i3], np.where(two, self.to[2][i2], self.to[1][i1]))
            total[:k] += np.where(j >= warm[:k], p, 0.0)
        own = np.empty(len(text))
        own[order] = total
        return np.bincount(text, weights=own, minlength=len(sizes))


SCORES = "n_tokens long, n_known long, train_tokens long, base_score double, score double"


def held_out_scores(docs: DataFrame, held: Column, doc_id: str = "doc_id", text: str = "text", mass: tuple[float, float] = MASS,
                    block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score for every row, from a
    model of the rows that are not held out. ``held`` is a condition on the column doc_id."""
    chosen = docs.select(F.col(doc_id).alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("text")).withColumn("held_out", held)
    total = chosen.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    parts = max(1, math.ceil(total / block_bytes))
    n, v, once, twice = statistics(chosen.where(~F.col("held_out")).select("text"), parts)
    discount = once / (once + 2 * twice) if once and twice else 0.5
    block = F.pmod(F.xxhash64("doc_id", "text"), F.lit(parts)).cast("long")
    dealt = chosen.withColumn("block", block).groupBy("block")

    def ask(table: pa.Table) -> pa.Table:
        rows: list[tuple] = []
        if table.num_rows:
            at = table.column("block")[0].as_py()
            tokens, sizes = Hasher().texts(utf8(table.column("text").combine_chunks()))
            train = np.repeat(~np.array(table.column("held_out").to_pylist(), dtype=bool), sizes)
            for order, keys in enumerate((tokens, *ngram_keys(tokens, sizes)), 1):
                rows += asks(at, order, *distinct(keys, train), parts)
            del tokens, keys, train
            give_back()
        return _table(rows, ASKS)

    def traverse(table: pa.Table, told: pa.Table) -> pa.Table:
        rows = table.num_rows
        x = Numbered(utf8(table.column("text").combine_chunks()) if rows else [])
        pieces: dict[int, list] = {1: [], 2: [], 3: []}
        for o, part, m, totals in sorted(zip(*(told.column(c).to_pylist() for c in ("ord", "part", "n", "totals")))):
            pieces[o].append(unpacked(totals, m).astype(np.int64))
        counts = {o: np.concatenate(p) if p else np.zeros(x.n[o], np.int64) for o, p in pieces.items()}
        c = counts[1]
        own = np.where(c > 0, (c - discount) / n, discount * v / n) if n else np.ones(len(c))
        score = Automaton(x, counts, own, mass).score(x) if n else np.zeros(rows)
        of = np.repeat(np.arange(rows), x.sizes)
        base = np.bincount(of, weights=(np.log10((c + 1) / (n + v + 1)))[x.place[1]], minlength=rows)
        known = np.bincount(of, weights=(c > 0)[x.place[1]], minlength=rows).astype(np.int64)
        out = pa.table([table.column("doc_id"), table.column("held_out"), pa.array(x.sizes.astype(np.int64)), pa.array(known),
                        pa.array(np.full(rows, n, dtype=np.int64)), pa.array(base), pa.array(score)],
                       names=["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"])
        del x, counts, pieces, of
        give_back()
        return out

    told = dealt.applyInArrow(ask, ASKS).groupBy("ord", "part").applyInArrow(answer, TOLD)
    kind = chosen.schema["doc_id"].dataType.simpleString()
    return dealt.cogroup(told.groupBy("block")).applyInArrow(traverse, f"doc_id {kind}, held_out boolean, {SCORES}")
