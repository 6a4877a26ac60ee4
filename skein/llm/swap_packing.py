"""Packing of documents into sequences of a fixed number of tokens, by swap-based local search.

Documents become token ids (by the ``tokenizers`` library) with an end id each; only documents longer
than a sequence are cut. A block of pieces is packed best fit, longest piece first, and then improved:
between two underfull bins a document moves, or one is exchanged for one, two for one or one for two,
whenever this raises the sum of the squared fills. The fuller bin gets fuller and the emptier one
emptier, until it is empty and goes. The sum is a whole number that only rises, so the search ends;
it also ends when a block needs as many bins as its tokens demand.

Scale: tokenizing is row-local and hands on narrow rows (no ids, no text) with a unique number; the
number, not the content, deals pieces to blocks of about ``BLOCK_PIECES``, so equal documents and hot
sources spread evenly. A block is one group of bounded size. Bins that a block leaves below ``CLOSED``
of a sequence are opened again and their pieces dealt to new blocks, until one block holds them all or
a round no longer helps: what blocks lose against one another is a fraction of a bin each, and later
rounds win it back. Each round is written to the shared folder, so lost executors only repeat tasks.

Defined results: a null text is an empty one, which has its end id alone (length 1); repeated rows
and rows without an id are packed once each; very long texts are cut into whole sequences and a last
piece; an empty table gives no rows. Columns of the input never clash: only id and text are read.
"""

from __future__ import annotations

import json
import math
import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skein.llm.common import give_back
from skein.session import write_table

MAX_TOKENS = 4_096
END_ID = 1
BLOCK_PIECES = 8_192
#: Share of a sequence from which a bin stays as it is.
CLOSED = 0.995
#: Share of the open pieces above which another round is not worth its pass.
KEEP_ON = 0.8
#: Searches for an exchange that a block may make.
STEPS = 1_000
#: Words and parts of words that a worker remembers, in each of two generations.
TABLE_WORDS = 400_000
#: Bytes of text whose words are made distinct together.
SLICE_BYTES = 8 * 1024 * 1024

#: Marks, letters (ASCII or Latin-1), marks. An apostrophe before letters may be a contraction.
_SIMPLE = r"^(?P<lead>[!-&(-/:-@\[-`{-~]*)(?P<core>[A-Za-z\x{C0}-\x{D6}\x{D8}-\x{F6}\x{F8}-\x{FF}]+)(?P<tail>[!-/:-@\[-`{-~]*)$"


# ------------------------------------------------------------------ tokens

class Table:
    """Ids by word, in two generations: what was not used since the table was last full but one is forgotten."""

    def __init__(self, limit: int):
        self.young, self.old, self.limit = {"": b""}, {}, limit

    def get(self, words: list[str], make: Callable[[list[str]], list[bytes]]) -> list[bytes]:
        found = list(map(self.young.get, words))
        if None in found:
            fresh = {w: self.old.get(w) for w, ids in zip(words, found) if ids is None}
            new = [w for w, ids in fresh.items() if ids is None]
            fresh.update(zip(new, make(new)))
            found = [fresh[w] if ids is None else ids for w, ids in zip(words, found)]
            self.young.update(fresh)
            if len(self.young) >= self.limit:
                self.old, self.young = self.young, {"": b""}
        return found


class WordEncoder:
    """Ids of texts as bytes (little-endian unsigned 32-bit), equal to the library's own.

    The tokenizer drops white space and its tokens don't cross it, so a text's ids are its words' ids
    in order; the distinct words of a slice of texts are looked up, and the library is given each one
    that the table doesn't hold. A word of letters between marks is made of parts that the tokenizer
    splits as well, and whose case and normal form are plain, so its parts are looked up instead.
    Tokenizers without these properties (``checked`` is False) are given whole texts.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer
        self.tokenizer = Tokenizer.from_file(path)
        self.table = Table(TABLE_WORDS)
        self.last = self._word_ends()
        self.checked = self.last is not None

    def _word_ends(self) -> np.ndarray | None:
        """Which ids end a word, if the tokenizer is of the kind described above."""
        spec = json.loads(self.tokenizer.to_str())
        kinds = [n["type"] for n in (spec.get("normalizer") or {}).get("normalizers", [])]
        split = (spec.get("pre_tokenizer") or {}).get("pretokenizers", [])
        # Fixed value: the split of words that this reading of a text relies on.
        pattern = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
        if kinds != ["NFC", "Replace", "Lowercase"] or not split or split[0].get("pattern", {}).get("Regex") != pattern:
            return None
        end = spec["model"].get("end_of_word_suffix")
        vocabulary = self.tokenizer.get_vocab(with_added_tokens=True)
        out = np.zeros(max(vocabulary.values()) + 1, dtype=bool)
        out[[i for w, i in vocabulary.items() if end and w.endswith(end)]] = True
        return out

    def _whole(self, texts: list[str]) -> list[bytes]:
        return [np.array(e.ids, dtype="<u4").tobytes() for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def _parts(self, parts: list[str]) -> list[bytes]:
        """Parts hold one word end each: encode many in one string and cut it after these."""
        out: list[bytes] = []
        for at in range(0, len(parts), 2_000):
            some = parts[at: at + 2_000]
            ids = np.array(self.tokenizer.encode_batch_fast([" ".join(some)], add_special_tokens=False)[0].ids, dtype="<u4")
            ends = (4 * (np.flatnonzero(self.last[ids]) + 1)).tolist()
            if len(ends) == len(some) and ends[-1] == 4 * len(ids):
                data = ids.tobytes()
                out += [data[a:b] for a, b in zip([0, *ends], ends)]
            else:
                out += self._whole(some)
        return out

    def _ids(self, words: pa.Array, make: Callable[[list[str]], list[bytes]]) -> pa.Array:
        """Ids of each word, the empty word's being none."""
        coded = words.dictionary_encode()
        return pa.array(self.table.get(coded.dictionary.to_pylist(), make), pa.large_binary()).take(coded.indices)

    def _distinct(self, words: pa.Array) -> pa.Array:
        """Ids of distinct words."""
        parts = pc.extract_regex(words, _SIMPLE)
        simple = pc.and_(parts.is_valid(), pc.invert(pc.match_substring(words, "<|")))  # these marks belong to special tokens
        made = parts.filter(simple)
        lead, core, tail = (self._ids(p, self._parts) for p in (made.field(0), pc.ascii_lower(made.field(1)), made.field(2)))
        joined = pc.binary_join_element_wise(lead, core, tail, pa.scalar(b"", pa.large_binary()))
        hard = self._ids(words.filter(pc.invert(simple)), self._whole)
        order = pc.if_else(simple, pc.cumulative_sum(simple.cast(pa.int64())), pc.add(pc.cumulative_sum(pc.invert(simple).cast(pa.int64())), len(joined)))
        return pa.concat_arrays([joined, hard]).take(pc.subtract(order, 1))

    def encode(self, texts: pa.Array) -> list[bytes]:
        """Ids of texts without nulls."""
        if not self.checked:
            return self._whole(texts.to_pylist())
        lists = pc.ascii_split_whitespace(texts.cast(pa.large_string()))  # any other white space stays inside a word, for the library
        coded = lists.flatten().dictionary_encode()
        if not len(coded):
            return [b""] * len(texts)
        ids = self._distinct(coded.dictionary).take(coded.indices)
        word_at = lists.offsets.to_numpy() - lists.offsets[0].as_py()
        _, offsets, data = ids.buffers()
        at = np.frombuffer(offsets, dtype=np.int64)[ids.offset: ids.offset + len(ids) + 1][word_at].tolist()
        view = memoryview(data) if data else b""
        return [bytes(view[a:b]) for a, b in zip(at, at[1:])]


#: Encoders of this worker process by path; Spark keeps the process for later tasks.
_ENCODERS: dict[str, WordEncoder] = {}


def _encoder(path: str) -> WordEncoder:
    if path not in _ENCODERS:
        _ENCODERS[path] = WordEncoder(path)
    return _ENCODERS[path]


def slices(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    """Parts of a batch with about ``SLICE_BYTES`` of text (a longer text is one alone)."""
    ends = np.cumsum(pc.fill_null(pc.binary_length(batch.column(1)), 0).to_numpy(zero_copy_only=False).astype(np.int64)) if batch.num_rows else np.zeros(0)
    cut = np.flatnonzero(np.diff(ends // SLICE_BYTES)) + 1 if len(ends) else []
    for a, b in zip([0, *cut], [*cut, batch.num_rows]):
        if b > a:
            yield batch.slice(int(a), int(b - a))


def pieces(docs: DataFrame, tokenizer: str, doc_id: str = "doc_id", text: str = "text", max_tokens: int = MAX_TOKENS, end_id: int = END_ID, ids: bool = False) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32 (and with ``ids`` the ids themselves, little-endian
    unsigned 32-bit) of every piece of every row."""
    end, step = np.array([end_id], dtype="<u4").tobytes(), 4 * max_tokens
    schema = "doc_id long, piece int, start long, length long, ids_crc32 long" + (", ids binary" if ids else "")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _encoder(tokenizer)
        for b in batches:
            for part in slices(b):
                own, data = [], []
                for doc, coded in zip(part.column(0).to_pylist(), encoder.encode(part.column(1).fill_null(""))):
                    coded += end
                    for k, start in enumerate(range(0, len(coded), step)):
                        own.append((doc, k, k * max_tokens))
                        data.append(coded[start: start + step])
                columns = [pa.array([o[0] for o in own], pa.int64()), pa.array([o[1] for o in own], pa.int32()), pa.array([o[2] for o in own], pa.int64()),
                           pa.array([len(d) // 4 for d in data], pa.int64()), pa.array([zlib.crc32(d) for d in data], pa.int64())]
                yield pa.RecordBatch.from_arrays(columns + [pa.array(data, pa.binary())] * ids, schema=_arrow(ids))
        give_back()

    return docs.select(F.col(f"`{doc_id}`").cast("long").alias("doc_id"), F.col(f"`{text}`").alias("text")).mapInArrow(run, schema)


def _arrow(ids: bool) -> pa.Schema:
    fields = [("doc_id", pa.int64()), ("piece", pa.int32()), ("start", pa.int64()), ("length", pa.int64()), ("ids_crc32", pa.int64())]
    return pa.schema(fields + [("ids", pa.binary())] * ids)


# ------------------------------------------------------------------ packing of a block

def best_fit(lengths: list[int], size: int) -> list[list[int]]:
    """Bins (lists of indices): longest first, each into the fullest bin that takes it."""
    bins: list[list[int]] = []
    by_gap: list[list[int]] = [[] for _ in range(size + 1)]
    gaps = 0  # bit g: some bin has g places left
    for i in sorted(range(len(lengths)), key=lambda i: -lengths[i]):
        need = lengths[i]
        rest = gaps >> need
        if rest:
            g = need + (rest & -rest).bit_length() - 1
            b = by_gap[g].pop()
            if not by_gap[g]:
                gaps &= ~(1 << g)
        else:
            g, b = size, len(bins)
            bins.append([])
        bins[b].append(i)
        by_gap[g - need].append(b)
        gaps |= 1 << (g - need)
    return bins


class Options:
    """What a bin can give: single documents and pairs, by distinct sums of lengths. Distinct lengths
    of a bin add up to at most its size, so a bin has few of them however many documents it holds."""

    def __init__(self, bin_: list[int], lengths: list[int]):
        by_length: dict[int, list[int]] = {}
        for i in bin_:
            by_length.setdefault(lengths[i], []).append(i)
        kinds = sorted(by_length)
        pairs: dict[int, tuple[int, int]] = {}
        for a, x in enumerate(kinds):
            for y in kinds[a:]:
                if x != y or len(by_length[x]) > 1:
                    pairs.setdefault(x + y, (x, y))
        self.by_length = by_length
        self.sums = np.array([0, *kinds, *pairs], dtype=np.int64)
        self.parts: list[tuple[int, ...]] = [(), *[(x,) for x in kinds], *pairs.values()]
        self.singles = 1 + len(kinds)  # first pair

    def take(self, option: int) -> list[int]:
        """Indices of the documents of an option."""
        parts = self.parts[option]
        if len(parts) == 2 and parts[0] == parts[1]:
            return self.by_length[parts[0]][:2]
        return [self.by_length[p][0] for p in parts]


def _best_exchange(give: Options, fill: int, others: list[tuple[int, Options, int]], size: int) -> tuple[int, int, int] | None:
    """(other, option given, option taken) that raises the squared fill most: the other bin, now
    fuller by d, takes a single for nothing, a single or a pair, or a pair for a single."""
    sums = np.concatenate([o.sums for _, o, _ in others])
    counts = [len(o.sums) for _, o, _ in others]
    fills = np.repeat(np.array([f for _, _, f in others]), counts)
    pair = np.concatenate([np.arange(len(o.sums)) >= o.singles for _, o, _ in others])
    single = ~pair & (sums > 0)
    best, found = 0, None
    for low, high, allowed in ((1, give.singles, None), (give.singles, len(give.sums), single)):
        if low >= high:
            continue
        at = np.arange(len(sums)) if allowed is None else np.flatnonzero(allowed)
        d = give.sums[low:high, None] - sums[at][None, :]
        gain = np.where((d > 0) & (d <= size - fills[at]), d * (fills[at] - fill + d), 0)
        if gain.size and gain.max() > best:
            best = int(gain.max())
            row, col = np.unravel_index(int(gain.argmax()), gain.shape)
            found = (low + int(row), int(at[col]))
    if found is None:
        return None
    ends = np.cumsum(counts)
    which = int(np.searchsorted(ends, found[1], side="right"))
    return which, found[0], found[1] - (int(ends[which]) - counts[which])


def local_search(bins: list[list[int]], lengths: list[int], size: int, steps: int = STEPS) -> list[list[int]]:
    """Exchanges between underfull bins until as few bins are left as the tokens need, or none helps."""
    need = -(-sum(lengths) // size)
    fill = {b: sum(lengths[i] for i in own) for b, own in enumerate(bins)}
    own = dict(enumerate(bins))
    options = {b: Options(own[b], lengths) for b in own if fill[b] < size} if len(bins) > need else {}
    stuck: set[int] = set()
    while len(own) > need and steps > 0:
        source = min((b for b in options if b not in stuck), key=lambda b: (fill[b], b), default=None)
        others = [(b, options[b], fill[b]) for b in options if b != source]
        if source is None or not others:
            break
        steps -= 1
        found = _best_exchange(options[source], fill[source], others, size)
        if found is None:
            stuck.add(source)
            continue
        target = others[found[0]][0]
        give, take = options[source].take(found[1]), options[target].take(found[2])
        for b, out, into in ((source, give, take), (target, take, give)):
            own[b] = [i for i in own[b] if i not in out] + into
            fill[b] = sum(lengths[i] for i in own[b])
            del options[b]
            if not own[b]:
                del own[b]
            elif fill[b] < size:
                options[b] = Options(own[b], lengths)
        stuck.clear()
    return list(own.values())


def pack_block(lengths: list[int], size: int, steps: int = STEPS) -> list[list[int]]:
    return local_search(best_fit(lengths, size), lengths, size, steps)


# ------------------------------------------------------------------ packing of a table

_PLACED = "doc_id long, piece int, start long, length long, ids_crc32 long, number long, sequence_id long, offset long, fill long"


def _pack_blocks(rows: DataFrame, blocks: int, turn: int, size: int, steps: int) -> DataFrame:
    def run(table: pa.Table) -> pa.Table:
        table = table.sort_by("number")  # the same result however rows arrive
        lengths, number = table.column("length").to_pylist(), table.column("number").to_pylist()
        sequence, offset, full = [0] * len(lengths), [0] * len(lengths), [0] * len(lengths)
        for own in pack_block(lengths, size, steps):
            name, at, total = min(number[i] for i in own), 0, sum(lengths[i] for i in own)
            for i in sorted(own):
                sequence[i], offset[i], full[i] = name, at, total
                at += lengths[i]
        out = table.select(["doc_id", "piece", "start", "length", "ids_crc32", "number"])
        for name, values in (("sequence_id", sequence), ("offset", offset), ("fill", full)):
            out = out.append_column(name, pa.array(values, pa.int64()))
        return out

    block = F.pmod(F.xxhash64("number", F.lit(turn)), F.lit(blocks))
    return rows.select("doc_id", "piece", "start", "length", "ids_crc32", "number", block.alias("block")).groupBy("block").applyInArrow(run, _PLACED)


def place(cut: DataFrame, size: int = MAX_TOKENS, block_pieces: int = BLOCK_PIECES, closed: float = CLOSED, steps: int = STEPS) -> DataFrame:
    """``cut`` (of ``pieces``, without ids) with sequence_id (the smallest piece number of the
    sequence), offset and fill. A sequence's pieces are gapless from offset 0."""
    numbered = write_table(cut.withColumn("number", F.monotonically_increasing_id()), "pieces")
    whole = numbered.where(F.col("length") == size).select("*", F.col("number").alias("sequence_id"), F.lit(0).cast("long").alias("offset"), F.col("length").alias("fill"))
    left, done, turn = numbered.where(F.col("length") < size), [whole], 0
    count = left.count()
    while count:
        blocks = math.ceil(count / block_pieces)
        placed = write_table(_pack_blocks(left, blocks, turn, size, steps), "placed")
        if blocks == 1:
            done.append(placed)
            break
        left = placed.where(F.col("fill") < closed * size)
        again, turn = left.count(), turn + 1
        if again > KEEP_ON * count:  # most bins can't be filled better
            done.append(placed)
            break
        done.append(placed.where(F.col("fill") >= closed * size))
        count = again
    out = done[0]
    for part in done[1:]:
        out = out.unionByName(part)
    return out.drop("number")


def pack(docs: DataFrame, tokenizer: str, doc_id: str = "doc_id", text: str = "text", max_tokens: int = MAX_TOKENS, end_id: int = END_ID, **options) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32, sequence_id, offset, fill of every piece of ``docs``."""
    return place(pieces(docs, tokenizer, doc_id, text, max_tokens, end_id), max_tokens, **options)


def assemble(placed: DataFrame, cut: DataFrame) -> DataFrame:
    """sequence_id and ids (bytes) of every sequence, from places and the pieces with their ids; a
    group is one sequence. Pieces are matched by document, piece and digest."""
    keys = ["doc_id", "piece", "ids_crc32"]
    ids = cut.groupBy(*keys).agg(F.first("ids").alias("ids"))  # repeated rows have equal ids
    ids = ids.select(F.col("ids"), *[F.col(k).alias(f"_{k}") for k in keys])
    joined = placed.join(ids, F.col("doc_id").eqNullSafe(F.col("_doc_id")) & (F.col("piece") == F.col("_piece")) & (F.col("ids_crc32") == F.col("_ids_crc32")))
    parts = joined.groupBy("sequence_id").agg(F.sort_array(F.collect_list(F.struct("offset", "ids"))).alias("p"))
    return parts.select("sequence_id", F.aggregate("p", F.lit(b"").cast("binary"), lambda a, x: F.concat(a, x["ids"])).alias("ids"))
