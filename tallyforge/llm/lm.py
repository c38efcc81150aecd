"""Language-model scores by online logistic context mixing, beside a word-count base score.

A text is coded byte by byte and ends in an end symbol. Each symbol is a path in a Huffman tree
of the corpus, so a byte takes few yes/no decisions. For every decision several predictors look
up their context, the last one to three symbols or the word so far, and the place in the tree, in hashed tables of
how often it went either way in the training texts. Their log odds are mixed with weights that a
gate picks by how well the two longest contexts are known; the weights are trained online,
decision after decision, each left out of the counts that predict it. There are several such
mixers, over short or long contexts.

Beside the mixers stands a predictor of whole blocks, whose table grows with the corpus. Texts are
cut into blocks of about BLOCK_WORDS words where their content says so, so that equal passages are
cut alike wherever they stand. All blocks of the training texts are counted under their hashes; the
next block is predicted in proportion to its count, and what the mixers say stands for a block not
seen. A training text's own blocks are left out of the counts that predict it, so it
gains from a passage only if another training text has it too.

Along a text the shares of mixers and block predictor adapt: after every block a share grows with
the probability given to the block, and a part is dealt out evenly, so that the mixture can change
its mind. The probability of a text is that of its blocks under the shares held before each; bits
per byte follow.

The counts cover all training texts: byte strings are counted in the tasks, summed by a shuffle,
and folded into tables of fixed size, which alone are sent to all tasks. Block counts stay in a
table that is joined: the most frequent ones, a fixed number, by broadcast, the others by a shuffle.

The base score needs the count of every word. The most frequent words, a fixed number, go to all
tasks; the others are joined by a shuffle.

NULL texts are empty and have the end symbol only. A row without an id is a training row. With no
training text all predictions are even.
"""

from __future__ import annotations

import heapq
import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyforge.llm.hashing import ODD, powers, scramble
from tallyforge.llm.rows import ROW
from tallyforge.sources.storage import materialize

#: Contexts: the last one to ORDERS symbols, and a hash of the word so far.
ORDERS = 3
CONTEXTS = ORDERS + 1
END = START = 256
SYMBOLS, SYMBOL_BITS, WORD_BITS = 257, 9, 27
#: Table sizes of the predictors, by context, in bits.
TABLE_BITS = (17, 20, 20, 21)
#: Which contexts each mixer uses.
MIXERS = ((1, 1, 1, 0), (0, 1, 1, 1))
#: Levels of how often a context was seen, for the two longest contexts.
LEVELS = 4
GATES = LEVELS * LEVELS
#: Words that a block has on average, and bytes that it has at most.
BLOCK_WORDS, BLOCK_BYTES = 16, 512
#: Bytes before a space that decide whether a block ends there.
CUT_BYTES = 8
#: The part of the shares dealt out evenly after every block.
EVEN_PART = 0.02
#: Bytes before a part of a long text that its contexts can see.
LOOK_BACK = 64
#: Blocks whose counts are joined by broadcast.
HEAD_BLOCKS = 1 << 18
DELTA = 0.4
#: Bytes handled at once, and distinct strings held before they are passed on.
CHUNK_BYTES, HELD, HELD_STRINGS = 4 << 20, 1 << 20, 1 << 21
#: Bytes whose strings are made at once, few enough for the processor's caches.
CACHED_BYTES = 1 << 17
#: Strings whose decisions are worked out at once, and strings that one task folds into tables.
STRINGS_AT_ONCE, FOLDED = 1 << 17, 1 << 22
#: Frequent words that every task holds.
HEAD_WORDS = 1 << 17
#: The token that ends a text; no word is empty.
END_TOKEN = ""
SLOT_OFFSETS = tuple(np.cumsum([0, *(1 << bits for bits in TABLE_BITS)]).tolist())
_CHUNK_SLOTS = 1 << 16


@dataclass(frozen=True)
class Code:
    """Huffman code: of symbol s the tree nodes and bits are at ``begin[s]:begin[s + 1]``."""

    begin: np.ndarray
    nodes: np.ndarray
    bits: np.ndarray


def huffman(counts: dict[int, int]) -> Code:
    """Code of all symbols; each is taken to occur once more than counted."""
    heap: list[tuple[int, int, object]] = [(counts.get(s, 0) + 1, s, s) for s in range(SYMBOLS)]
    heapq.heapify(heap)
    number = SYMBOLS
    while len(heap) > 1:
        a, b = heapq.heappop(heap), heapq.heappop(heap)
        heapq.heappush(heap, (a[0] + b[0], number, (a[2], b[2])))
        number += 1
    paths: dict[int, list[tuple[int, int]]] = {}
    stack, node = [(heap[0][2], [])], 0
    while stack:
        tree, path = stack.pop()
        if isinstance(tree, tuple):
            stack += [(tree[bit], [*path, (node, bit)]) for bit in (0, 1)]
            node += 1
        else:
            paths[tree] = path
    begin = np.cumsum([0, *(len(paths[s]) for s in range(SYMBOLS))])
    flat = np.array([step for s in range(SYMBOLS) for step in paths[s]], np.int64)
    return Code(begin, flat[:, 0], flat[:, 1])


@dataclass(frozen=True)
class Part:
    """A stretch of a text with the bytes before it; the last one of a text has the end symbol."""

    before: bytes
    data: bytes
    last: bool


def _chunks(texts: list[bytes]) -> Iterator[list[Part]]:
    """The texts in order, long ones cut at block ends, some megabytes at a time."""
    held, size = [], 0
    for text in texts:
        begin, last = 0, False
        while not last:
            last = len(text) - begin <= CHUNK_BYTES
            end = len(text) if last else begin + _last_block(text, begin)
            part = Part(text[max(0, begin - LOOK_BACK) : begin], text[begin:end], last)
            if held and size + len(part.data) > CHUNK_BYTES:
                yield held
                held, size = [], 0
            held.append(part)
            size += len(part.data)
            begin = end
    if held:
        yield held


def _groups(parts: list[Part]) -> Iterator[list[Part]]:
    """The parts in order, few bytes at a time."""
    held, size = [], 0
    for part in parts:
        if held and size + len(part.data) > CACHED_BYTES:
            yield held
            held, size = [], 0
        held.append(part)
        size += len(part.data)
    if held:
        yield held


_CODES = scramble(np.arange(256, dtype=np.uint64))


def _spaces(data: np.ndarray) -> np.ndarray:
    return np.flatnonzero((data == 32) | ((data >= 9) & (data <= 13)))


def _cuts(data: np.ndarray, begin: np.ndarray, spaces: np.ndarray) -> np.ndarray:
    """Places behind the spaces where the bytes before, back to the part's begin, end a block."""
    first = begin[np.searchsorted(begin, spaces, side="right") - 1]
    window = np.zeros(len(spaces), np.uint64)
    for back in range(1, CUT_BYTES + 1):
        at = spaces - back
        window = (window << np.uint64(8)) | np.where(at >= first, data[at], 0).astype(np.uint64)
    return spaces[scramble(window) % np.uint64(BLOCK_WORDS) == 0] + 1


def _block_begins(data: np.ndarray, begin: np.ndarray, spaces: np.ndarray, first: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Where blocks begin in ``data``, of which the parts' own symbols are at ``first`` to ``end``."""
    cuts = _cuts(data, begin, spaces)
    part = np.searchsorted(begin, cuts, side="right") - 1
    cuts = cuts[(cuts > first[part]) & (cuts < end[part])]
    begins = np.sort(np.concatenate([first[first < end], cuts]))
    ends = np.append(begins[1:], len(data))
    ends = np.minimum(ends, end[np.searchsorted(begin, begins, side="right") - 1])
    pieces = -(-(ends - begins) // BLOCK_BYTES)
    within = np.arange(pieces.sum()) - np.repeat(np.cumsum(pieces) - pieces, pieces)
    return np.repeat(begins, pieces) + BLOCK_BYTES * within


def _last_block(text: bytes, begin: int) -> int:
    """Bytes from ``begin`` to where the last block that begins within CHUNK_BYTES begins."""
    before = min(begin, LOOK_BACK)
    data = np.frombuffer(text[begin - before : begin + CHUNK_BYTES], np.uint8)
    begins = _block_begins(data, np.array([0]), _spaces(data), np.array([before]), np.array([len(data)]))
    return int(begins[-1]) - before


def _word_so_far(sums: np.ndarray, down: np.ndarray, begin: np.ndarray, spaces: np.ndarray) -> np.ndarray:
    """Per position a hash of the bytes after the last space before it, back to the part's begin."""
    n = len(sums) - 1
    start = np.sort(np.concatenate([begin, spaces + 1]))
    start = start[start < n]
    sizes = np.diff(np.append(start, n))
    hashes = (sums[:n] - np.repeat(sums[start], sizes)) * np.repeat(down[start], sizes)
    return ((hashes * np.uint64(ODD)) >> np.uint64(64 - WORD_BITS)).astype(np.int64)


@dataclass(frozen=True)
class Symbols:
    """Symbols of some parts: each with its contexts packed in one integer, and the blocks of them."""

    strings: np.ndarray
    sizes: np.ndarray
    block_begin: np.ndarray
    block_key: np.ndarray


def _symbols(parts: list[Part], with_blocks: bool, ready: tuple[np.ndarray, np.ndarray]) -> Symbols:
    spans = np.array([len(part.before) + len(part.data) + 1 for part in parts])
    begin = np.cumsum(spans) - spans
    data = np.frombuffer(b"".join(part.before + part.data + b"\0" for part in parts), np.uint8)
    spaces = _spaces(data)
    up, down = ready if len(data) < len(ready[0]) else powers(len(data) + 1)
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(_CODES[data] * up[: len(data)], out=sums[1:])
    symbols = data.astype(np.int64)
    symbols[begin + spans - 1] = END
    packed = _word_so_far(sums, down, begin, spaces) << (SYMBOL_BITS * CONTEXTS)
    packed |= symbols
    for back in range(1, ORDERS + 1):
        before = np.empty_like(symbols)
        before[back:] = symbols[:-back]
        for place in range(back):
            before[np.minimum(begin + place, begin + spans - 1)] = START
        before <<= SYMBOL_BITS * back
        packed |= before
    sizes = np.array([len(part.data) + part.last for part in parts])
    first = begin + np.array([len(part.before) for part in parts])
    block_begin, block_key = np.zeros(0, np.int64), np.zeros(0, np.int64)
    if with_blocks:
        block_begin = _block_begins(data, begin, spaces, first, first + sizes)
        part = np.searchsorted(begin, block_begin, side="right") - 1
        end = np.minimum(np.append(block_begin[1:], len(data)), (first + sizes)[part])
        # The block with the end symbol has it in its key, not in its bytes.
        ended = (end == (first + sizes)[part]) & np.array([p.last for p in parts])[part]
        size = (end - block_begin - ended).astype(np.uint64)
        own = (sums[end - ended] - sums[block_begin]) * down[block_begin]
        block_key = scramble(own ^ (size << np.uint64(1) | ended.astype(np.uint64)) * np.uint64(ODD)).view(np.int64)
        block_begin = block_begin - first[part] + (np.cumsum(sizes) - sizes)[part]
    if len(packed) > sizes.sum():  # cut texts: without the bytes before, and the end of parts that go on
        wanted = np.ones(len(packed), bool)
        for part, start, span in zip(parts, begin, spans):
            wanted[start : start + len(part.before)] = False
            wanted[start + span - 1] = part.last
        packed = packed[wanted]
    return Symbols(packed, sizes, block_begin, block_key)


def symbol_strings(parts: list[Part]) -> tuple[np.ndarray, np.ndarray]:
    """Every symbol with its contexts, packed in one integer, and the parts' sizes."""
    ready = powers(2 * CACHED_BYTES)
    made = [_symbols(group, False, ready) for group in _groups(parts)]
    return np.concatenate([m.strings for m in made]), np.concatenate([m.sizes for m in made])


def _bytes(batch: pa.RecordBatch) -> list[bytes]:
    return batch.column("text").cast(pa.binary()).to_pylist()


def count_strings(texts: DataFrame) -> DataFrame:
    """``string`` and its ``times`` in the ``text`` of all rows."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pd.Series] = []
        size = 0
        for batch in batches:
            for parts in _chunks(_bytes(batch)):
                codes, strings = pd.factorize(symbol_strings(parts)[0])
                held.append(pd.Series(np.bincount(codes), index=strings))
                size += len(strings)
                if size > HELD_STRINGS:
                    held = [pd.concat(held).groupby(level=0, sort=False).sum()]
                    size = len(held[0])
                    if size > HELD_STRINGS // 2:
                        yield packed(held[0])
                        held, size = [], 0
        if held:
            yield packed(pd.concat(held).groupby(level=0, sort=False).sum())

    def packed(counts: pd.Series) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(counts.index.to_numpy()), pa.array(counts.to_numpy())], ["string", "times"])

    return texts.select("text").mapInArrow(count, "string long, times long").groupBy("string").agg(F.sum("times").alias("times"))


def _few_texts(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    """The rows in order, some megabytes of text at a time."""
    sizes = pc.binary_length(batch.column("text")).to_numpy(zero_copy_only=False)
    chunk = np.cumsum(sizes, dtype=np.int64) // CHUNK_BYTES
    ends = [*np.flatnonzero(np.diff(chunk)) + 1, batch.num_rows]
    begin = 0
    for end in map(int, ends):
        if end > begin:
            yield batch.slice(begin, end - begin)
            begin = end


def _tokens(batch: pa.RecordBatch) -> tuple[pa.Array, np.ndarray]:
    """The words of the texts, and of each the number of its text; Arrow splits at the same six characters."""
    lists = pc.ascii_split_whitespace(pc.ascii_lower(batch.column("text")))
    words = lists.flatten()
    owner = np.repeat(np.arange(len(lists)), pc.list_value_length(lists).to_numpy(zero_copy_only=False))
    some = pc.greater(pc.binary_length(words), 0)
    return words.filter(some), owner[some.to_numpy(zero_copy_only=False)]


def count_words(texts: DataFrame) -> DataFrame:
    """``token`` and its ``times``; every text ends in END_TOKEN."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.Table] = []
        size = 0
        for batch in batches:
            for part in _few_texts(batch):
                counted = pc.value_counts(_tokens(part)[0])
                held.append(table(counted.field(0), counted.field(1)))
                held.append(table(pa.array([END_TOKEN]), pa.array([part.num_rows])))
                size += len(counted)
                if size > HELD:
                    held = [summed(held)]
                    size = held[0].num_rows
                    if size > HELD // 2:
                        yield from held[0].to_batches()
                        held, size = [], 0
        if held:
            yield from summed(held).to_batches()

    def table(tokens: pa.Array, times: pa.Array) -> pa.Table:
        return pa.table({"token": tokens.cast(pa.string()), "times": times.cast(pa.int64())})

    def summed(tables: list[pa.Table]) -> pa.Table:
        sums = pa.concat_tables(tables).group_by("token").aggregate([("times", "sum")])
        return table(sums["token"], sums["times_sum"])

    return texts.select("text").mapInArrow(count, "token string, times long").groupBy("token").agg(F.sum("times").alias("times"))


def decisions(strings: np.ndarray, code: Code) -> tuple[np.ndarray, np.ndarray, list[np.ndarray]]:
    """Of every decision in coding the last symbols: string number, bit, and slot per context."""
    symbol = strings & ((1 << SYMBOL_BITS) - 1)
    steps = code.begin[symbol + 1] - code.begin[symbol]
    owner = np.repeat(np.arange(len(strings)), steps)
    step = np.arange(len(owner)) - np.repeat(np.cumsum(steps) - steps, steps) + code.begin[symbol][owner]
    node = code.nodes[step].astype(np.uint64)
    contexts = [(strings >> SYMBOL_BITS) & ((1 << (SYMBOL_BITS * order)) - 1) for order in range(1, ORDERS + 1)]
    contexts.append(strings >> (SYMBOL_BITS * CONTEXTS))
    slots = []
    for number, (context, bits) in enumerate(zip(contexts, TABLE_BITS)):
        mixed = scramble(context.astype(np.uint64) + np.uint64(number << 50))[owner] ^ node
        slots.append(((mixed * np.uint64(ODD)) >> np.uint64(64 - bits)).astype(np.int64))
    return owner, code.bits[step], slots


def _slot_counts(strings: DataFrame, code: Code) -> DataFrame:
    """``slot`` (numbered through all tables) with ``no`` and ``yes``, how often it went either way."""

    def fold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(2 * SLOT_OFFSETS[-1])
        for batch in batches:
            times = batch.column("times").to_numpy().astype(float)
            owner, bit, slots = decisions(batch.column("string").to_numpy(), code)
            for order, slot in enumerate(slots):
                at = 2 * (slot + SLOT_OFFSETS[order]) + bit
                np.add.at(total, at, times[owner])
        both = total.reshape(-1, 2)
        used = np.flatnonzero(both.any(axis=1))
        for begin in range(0, len(used), HELD):
            part = used[begin : begin + HELD]
            arrays = [pa.array(part), pa.array(both[part, 0]), pa.array(both[part, 1])]
            yield pa.RecordBatch.from_arrays(arrays, ["slot", "no", "yes"])

    folded = strings.mapInArrow(fold, "slot long, no double, yes double")
    return folded.groupBy("slot").agg(F.sum("no").alias("no"), F.sum("yes").alias("yes"))


def fold_tables(strings: DataFrame, code: Code) -> np.ndarray:
    """The predictors' tables, one row of two counts per slot; their size is fixed."""

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        dense: dict[int, np.ndarray] = {}
        for batch in batches:
            slot = batch.column("slot").to_numpy()
            for chunk in np.unique(slot // _CHUNK_SLOTS).tolist():
                rows = dense.setdefault(chunk, np.zeros((_CHUNK_SLOTS, 2), np.float32))
                here = slot // _CHUNK_SLOTS == chunk
                for k, name in enumerate(("no", "yes")):
                    rows[slot[here] % _CHUNK_SLOTS, k] = batch.column(name).to_numpy()[here]
        for chunk, rows in dense.items():
            yield pa.RecordBatch.from_arrays([pa.array([chunk], pa.int64()), pa.array([rows.tobytes()])], ["chunk", "counts"])

    # Every task may give a row per slot, so there are no more tasks than the strings need.
    counts = _slot_counts(strings.coalesce(max(1, strings.count() // FOLDED)), code)
    chunk = F.floor(F.col("slot") / _CHUNK_SLOTS)
    packed = counts.repartition(chunk).mapInArrow(pack, "chunk long, counts binary")
    table = np.zeros((SLOT_OFFSETS[-1] + _CHUNK_SLOTS, 2), np.float32)
    for row in packed.toLocalIterator():
        begin = row["chunk"] * _CHUNK_SLOTS
        table[begin : begin + _CHUNK_SLOTS] = np.frombuffer(row["counts"], np.float32).reshape(-1, 2)
    return table


@dataclass(frozen=True)
class Predictors:
    """Log odds and level of every slot: what the counts say, and how often it was seen."""

    odds: np.ndarray
    level: np.ndarray

    @staticmethod
    def of(counts: np.ndarray) -> Predictors:
        seen = counts.sum(axis=1)
        odds = np.log((counts[:, 1] + DELTA) / (counts[:, 0] + DELTA))
        return Predictors(odds.astype(np.float32), _level(seen))

    def look_up(self, slots: list[np.ndarray]) -> tuple[list[np.ndarray], np.ndarray]:
        """Log odds per context and the gate of every decision."""
        placed = [slot + SLOT_OFFSETS[number] for number, slot in enumerate(slots)]
        return [self.odds[at] for at in placed], _gate(*(self.level[at] for at in placed[-2:]))


def _level(seen: np.ndarray) -> np.ndarray:
    return np.minimum(LEVELS - 1, np.log2(1 + seen) / 3).astype(np.uint8)


def _gate(shorter: np.ndarray, longer: np.ndarray) -> np.ndarray:
    return shorter.astype(np.int64) * LEVELS + longer


def _left_out(counts: np.ndarray, slots: list[np.ndarray], bit: np.ndarray) -> tuple[list[np.ndarray], np.ndarray]:
    """The same from counts without one such outcome, for strings that have been counted."""
    odds, seen = [], []
    here = np.arange(len(bit))
    for number, slot in enumerate(slots):
        rows = counts[slot + SLOT_OFFSETS[number]]
        rows[here, bit] = np.maximum(rows[here, bit] - 1, 0)
        odds.append(np.log((rows[:, 1] + DELTA) / (rows[:, 0] + DELTA)))
        seen.append(rows.sum(axis=1))
    return odds, _gate(*map(_level, seen[-2:]))


def _mixed(odds: list[np.ndarray], gate: np.ndarray, weights: np.ndarray, uses: tuple) -> np.ndarray:
    """Log odds of one mixer, over the contexts it uses."""
    return sum(odds[k] * weights[:, k].astype(np.float32)[gate] for k in range(CONTEXTS) if uses[k])


def first_weights() -> np.ndarray:
    uses = np.array(MIXERS, float)
    return np.repeat((uses / uses.sum(axis=1, keepdims=True))[:, None, :], GATES, axis=1)


def train_weights(strings: DataFrame, code: Code, table, rate: float = 0.05, batch_rows: int = 4096) -> np.ndarray:
    """Weights by mixer, gate and order, trained online in every task over all strings, then averaged."""

    def train(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weights, rows = first_weights(), 0
        for batch in batches:
            for begin in range(0, batch.num_rows, batch_rows):
                part = batch.slice(begin, batch_rows)
                owner, bit, slots = decisions(part.column("string").to_numpy(), code)
                times = part.column("times").to_numpy().astype(float)[owner]
                odds, gate = _left_out(table.value, slots, bit)
                mass = np.maximum(np.bincount(gate, times, GATES), 1)
                for mixer, uses in enumerate(MIXERS):
                    miss = (bit - 1 / (1 + np.exp(-_mixed(odds, gate, weights[mixer], uses)))) * times
                    for k in range(CONTEXTS):
                        weights[mixer, :, k] += rate * uses[k] * np.bincount(gate, miss * odds[k], GATES) / mass
            rows += batch.num_rows
        if rows:
            yield pa.RecordBatch.from_arrays([pa.array([rows]), pa.array([weights.tobytes()])], ["rows", "weights"])

    # In hash order every batch is a fair sample; as counted, frequent strings would come first.
    shuffled = strings.sortWithinPartitions(F.xxhash64("string"))
    parts = shuffled.mapInArrow(train, "rows long, weights binary").collect()
    if not parts:
        return first_weights()
    each = [np.frombuffer(row["weights"]).reshape(len(MIXERS), GATES, CONTEXTS) for row in parts]
    return np.average(each, axis=0, weights=[row["rows"] for row in parts])


def string_costs(strings: np.ndarray, code: Code, predictors: Predictors, weights: np.ndarray) -> np.ndarray:
    """Natural-log probability of each string's last symbol under every mixer."""
    costs = np.empty((len(MIXERS), len(strings)))
    for begin in range(0, len(strings), STRINGS_AT_ONCE):
        part = slice(begin, begin + STRINGS_AT_ONCE)
        owner, bit, slots = decisions(strings[part], code)
        odds, gate = predictors.look_up(slots)
        sign = (1 - 2 * bit).astype(np.float32)
        first = np.flatnonzero(np.r_[True, owner[1:] != owner[:-1]])
        for mixer, uses in enumerate(MIXERS):
            # The probability of a symbol is the product over its path.
            chances = 1 / (1 + np.exp((sign * _mixed(odds, gate, weights[mixer], uses)).astype(float)))
            costs[mixer, part] = np.log(np.multiply.reduceat(chances, first))
    return costs


@dataclass(frozen=True)
class Blocks:
    """Blocks of texts in order: hash, natural-log probability under every mixer, and how many each text has."""

    key: np.ndarray
    cost: np.ndarray
    per_text: np.ndarray

    def own(self) -> np.ndarray:
        """At a block's first place in its text how often the text has it, elsewhere 0."""
        owner = np.repeat(np.arange(len(self.per_text)), self.per_text)
        order = np.lexsort((self.key, owner))
        first = np.ones(len(order), bool)
        first[1:] = (np.diff(owner[order]) != 0) | (np.diff(self.key[order]) != 0)
        at = np.flatnonzero(first)
        times = np.zeros(len(order), np.int64)
        times[order[at]] = np.diff(np.append(at, len(order)))
        return times


def block_costs(texts: list[bytes], code: Code, predictors: Predictors, weights: np.ndarray) -> Blocks:
    """What the mixers say about every block of the texts."""
    keys, costs, per_part, last = [], [], [], []
    ready = powers(2 * CACHED_BYTES)
    for parts in _chunks(texts):
        made = [_symbols(group, True, ready) for group in _groups(parts)]
        codes, strings = pd.factorize(np.concatenate([m.strings for m in made]))
        shift = np.cumsum([0, *(len(m.strings) for m in made)])
        begins = np.concatenate([m.block_begin + by for m, by in zip(made, shift)])
        by_string = string_costs(strings, code, predictors, weights)
        costs.append(np.stack([np.add.reduceat(row[codes], begins) for row in by_string]))
        keys += [m.block_key for m in made]
        ends = np.cumsum(np.concatenate([m.sizes for m in made]))
        per_part.append(np.diff(np.searchsorted(begins, ends), prepend=0))
        last += [part.last for part in parts]
    closed = np.flatnonzero(last)
    per_text = np.diff(np.cumsum(np.concatenate(per_part))[closed], prepend=0)
    return Blocks(np.concatenate(keys), np.concatenate(costs, axis=1), per_text)


def mix_blocks(cost: np.ndarray, per_text: np.ndarray, known: np.ndarray, total: np.ndarray) -> np.ndarray:
    """Natural-log probability of each text, the shares of mixers and block predictor adapting along it.

    ``known`` says how often other training text has each block, ``total`` of each text how many
    blocks of other training text there are.
    """
    if not len(per_text):
        return np.empty(0)
    mixers = np.logaddexp.reduce(cost, axis=0) - math.log(len(cost))
    with np.errstate(divide="ignore"):
        copied = np.logaddexp(np.log(known), mixers) - np.log(np.repeat(total, per_text) + 1.0)
    by_block = np.concatenate([cost, copied[None]])
    experts = len(by_block)
    first_block = np.cumsum(per_text) - per_text
    # Texts side by side, the longest first, one block at a time.
    order = np.argsort(-per_text, kind="stable")
    first_block, blocks = first_block[order], per_text[order]
    sums = np.zeros(len(order))
    shares = np.full((experts, len(order)), -math.log(experts))
    for step in range(int(blocks[0])):
        active = int(np.searchsorted(-blocks, -step, side="left"))
        joint = shares[:, :active] + by_block[:, first_block[:active] + step]
        top = joint.max(axis=0)
        gained = top + np.log(np.exp(joint - top).sum(axis=0))
        sums[:active] += gained
        shares[:, :active] = np.log((1 - EVEN_PART) * np.exp(joint - gained) + EVEN_PART / experts)
    result = np.empty(len(order))
    result[order] = sums
    return result


def text_log_probabilities(
    texts: list[bytes], code: Code, predictors: Predictors, weights: np.ndarray
) -> np.ndarray:
    """Natural-log probability of each text by a model that has counted no blocks."""
    if not texts:
        return np.empty(0)
    blocks = block_costs(texts, code, predictors, weights)
    return mix_blocks(blocks.cost, blocks.per_text, np.zeros(len(blocks.key)), np.zeros(len(texts)))


def known_blocks(scored: DataFrame) -> DataFrame:
    """Per row, if any, the blocks that other training texts have (``known_key``) and how often (``known``)."""
    pieces = scored.select(ROW, "held_out", F.explode(F.arrays_zip("block", "own")).alias("b"))
    pieces = pieces.select(ROW, "held_out", F.col("b.block").alias("block"), F.col("b.own").alias("own")).filter("own > 0")
    learned = F.sum(F.when(F.col("held_out"), 0).otherwise(F.col("own"))).alias("times")
    counts = pieces.groupBy("block").agg(learned, F.count(F.lit(1)).alias("texts"))
    repeated = materialize(counts.filter("texts > 1 AND times > 0"))
    head = repeated.orderBy(F.desc("texts"), "block").limit(HEAD_BLOCKS)
    found = pieces.join(F.broadcast(head), "block")
    if repeated.count() > HEAD_BLOCKS:
        head = materialize(head).select("block")
        tail = pieces.join(F.broadcast(head), "block", "left_anti")
        rest = repeated.join(F.broadcast(head), "block", "left_anti")
        found = found.unionByName(tail.join(rest, "block").select(found.columns))
    others = F.col("times") - F.when(F.col("held_out"), 0).otherwise(F.col("own"))
    found = found.select(ROW, "block", others.alias("known")).filter("known > 0")
    listed = found.groupBy(ROW).agg(F.collect_list(F.struct("block", "known")).alias("f"))
    return listed.select(ROW, F.col("f.block").alias("known_key"), F.col("f.known").alias("known"))


def _in_row(keys: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """One hash for a block and the row that it is in."""
    return scramble(keys.view(np.uint64) ^ scramble(rows.astype(np.uint64)))


def _final_scores(batch: pa.RecordBatch, train_blocks: int) -> np.ndarray:
    """log10 probabilities of rows that hold their blocks, the mixers' costs and the known blocks."""
    keys, costs = batch.column("block"), batch.column("cost")
    per_text = pc.list_value_length(keys).to_numpy(zero_copy_only=False).astype(np.int64)
    flat = keys.flatten().to_numpy(zero_copy_only=False)
    cost = costs.flatten().to_numpy(zero_copy_only=False).reshape(-1, len(MIXERS)).T.astype(float)
    known = np.zeros(len(flat))
    listed = batch.column("known_key")
    names = listed.flatten().to_numpy(zero_copy_only=False)
    if len(names):
        rows = np.repeat(np.arange(len(listed)), pc.fill_null(pc.list_value_length(listed), 0).to_numpy(zero_copy_only=False))
        names = _in_row(names, rows)
        order = np.argsort(names)
        names, times = names[order], batch.column("known").flatten().to_numpy(zero_copy_only=False)[order]
        wanted = _in_row(flat, np.repeat(np.arange(len(per_text)), per_text))
        at = np.minimum(np.searchsorted(names, wanted), len(names) - 1)
        known = np.where(names[at] == wanted, times[at], 0).astype(float)
    held_out = batch.column("held_out").to_numpy(zero_copy_only=False)
    total = train_blocks - np.where(held_out, 0, per_text)
    return mix_blocks(cost, per_text, known, total) / math.log(10)


def score_texts(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row its id, token counts, base score, model score and bits per byte."""
    spark = docs.sparkSession
    held_out = F.coalesce(F.crc32(F.col(key).cast("string").cast("binary")) % 5 == 1, F.lit(False))
    rows = docs.select(F.col(key).alias("id"), F.coalesce(F.col(text), F.lit("")).alias("text"), held_out.alias("held_out"))
    learned = rows.filter("NOT held_out")

    words = materialize(count_words(learned))
    vocabulary, train_tokens = words.agg(F.count(F.lit(1)), F.coalesce(F.sum("times"), F.lit(0))).first()
    head = words.orderBy(F.desc("times"), "token").limit(HEAD_WORDS).collect()
    strings = materialize(count_strings(learned))
    symbols = strings.groupBy(F.col("string").bitwiseAND(F.lit((1 << SYMBOL_BITS) - 1)).alias("symbol"))
    code = huffman({row["symbol"]: row["times"] for row in symbols.agg(F.sum("times").alias("times")).collect()})
    table = fold_tables(strings, code)
    weights = train_weights(strings, code, spark.sparkContext.broadcast(table))
    shared = spark.sparkContext.broadcast(Predictors.of(table))
    # The last entry stands for words outside the head.
    logs = np.array([*(math.log10(row["times"] + 0.5) for row in head), 0.0])
    shared_head = spark.sparkContext.broadcast(([row["token"] for row in head], logs))
    scale = math.log10(train_tokens + 0.5 * (vocabulary + 1))

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = pa.array(shared_head.value[0], pa.string())
        logs = shared_head.value[1]
        end = pc.index_in(pa.array([END_TOKEN]), value_set=names)[0].as_py()
        for batch in (part for whole in batches for part in _few_texts(whole)):
            n = batch.num_rows
            tokens, owner = _tokens(batch)
            at = pc.fill_null(pc.index_in(tokens, value_set=names), len(names)).to_numpy(zero_copy_only=False)
            other = at == len(names)
            n_tokens = np.bincount(owner, minlength=n) + 1
            n_other = np.bincount(owner[other], minlength=n)
            base = np.bincount(owner, logs[at], n) - n_tokens * scale
            ends = pa.array([[END_TOKEN] if end is None else []] * n, pa.list_(pa.string()))
            base += 0 if end is None else logs[end]
            others = pa.ListArray.from_arrays(pa.array(np.append(0, np.cumsum(n_other)), pa.int32()), tokens.filter(pa.array(other)))
            values = _bytes(batch)
            blocks = block_costs(values, code, shared.value, weights)
            begin = np.append(0, np.cumsum(blocks.per_text))
            lists = [
                pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(flat))
                for offsets, flat in (
                    (begin, blocks.key),
                    (begin, blocks.own()),
                    (begin * len(MIXERS), np.ascontiguousarray(blocks.cost.T).reshape(-1).astype(np.float32)),
                )
            ]
            head_known = n_tokens - n_other - (end is None)
            narrow = [pa.array(column) for column in (n_tokens, head_known, base)]
            sizes = pa.array([len(v) for v in values], pa.int64())
            columns = [batch.column(name) for name in ("id", "held_out", ROW)] + narrow + [others, ends, *lists, sizes]
            yield pa.RecordBatch.from_arrays(columns, [field.split()[0] for field in fields])

    kind = docs.schema[key].dataType.simpleString()
    fields = [
        f"id {kind}", "held_out boolean", f"{ROW} long", "n_tokens long", "head_known long", "head_score double",
        "token array<string>", "end array<string>", "block array<long>", "own array<long>", "cost array<float>", "n_bytes long",
    ]
    scored = materialize(rows.withColumn(ROW, F.monotonically_increasing_id()).mapInArrow(score, ", ".join(fields)))
    # Words outside the head: their counts come by a shuffle.
    seen = F.coalesce("times", F.lit(0))
    others = (
        scored.select(ROW, F.explode(F.concat("token", "end")).alias("token"))
        .join(words, "token", "left")
        .groupBy(ROW)
        .agg(
            F.sum(F.log10(seen + 0.5)).alias("rest_score"),
            F.sum(F.when(seen > 0, 1).otherwise(0)).alias("rest_known"),
        )
    )
    train_blocks = scored.agg(F.sum(F.when(~F.col("held_out"), F.size("block")))).first()[0] or 0
    base = [
        "id",
        "held_out",
        "n_tokens",
        (F.col("head_known") + F.coalesce("rest_known", F.lit(0))).alias("n_known"),
        F.lit(train_tokens).cast("long").alias("train_tokens"),
        (F.col("head_score") + F.coalesce("rest_score", F.lit(0.0))).alias("base_score"),
    ]
    joined = scored.drop("token", "end", "own").join(others, ROW, "left").join(known_blocks(scored), ROW, "left")
    joined = joined.select(*base, "n_bytes", "block", "cost", "known_key", "known")
    passed = ["id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score"]

    def finish(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            final = _final_scores(batch, train_blocks)
            bits = -final * math.log2(10) / np.maximum(batch.column("n_bytes").to_numpy(), 1)
            columns = [batch.column(name) for name in passed] + [pa.array(final), pa.array(bits)]
            yield pa.RecordBatch.from_arrays(columns, [*passed, "score", "bits_per_byte"])

    return joined.mapInArrow(
        finish,
        f"id {kind}, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, "
        "score double, bits_per_byte double",
    )


def score_report(docs: DataFrame) -> DataFrame:
    return score_texts(docs).withColumnRenamed("id", "doc_id")
