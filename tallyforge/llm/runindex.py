"""Removal of long repeats with run-length suffix indexes.

Every byte covered by a ``LENGTH``-byte string that also starts elsewhere goes. The corpus is
cut into pieces so that equal strings meet in one index:

* Of the ``ANCHOR``-byte strings inside a ``LENGTH``-byte window, the one with the smallest hash
  is the window's anchor. Equal windows have equal anchors at equal places. Consecutive windows
  with the same anchor form a piece, about 280 bytes, and every window lies in one piece.
* A piece whose anchor occurs once holds no repeat. Where all pieces of an anchor are equal,
  all of them are repeats. This settles most of the text by hash alone.
* The distinct pieces of the other anchors are brought together by anchor, some megabytes at a
  time, and indexed: suffix order, Burrows-Wheeler transform, its runs, and the text positions
  at run heads and tails. The match length of a position with its neighbour in suffix order is
  computed at these samples only; between samples it falls by one per byte, so one forward pass
  over the text streams the matching statistics. Positions that match ``LENGTH`` bytes are marked.
* An anchor with more distinct pieces than an index may hold is settled window by window with a
  grouped count instead; that is exact as well and has no bound.

A NULL text is an empty one. Texts shorter than ``LENGTH`` bytes keep everything. Repeated rows
are repeats of one another. Ids may be NULL or repeated.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyforge.llm.hashing import powers, scramble
from tallyforge.llm.rows import bounded
from tallyforge.sources.storage import materialize

LENGTH, ANCHOR = 200, 40
#: Text hashed at once; longer texts are hashed in overlapping parts. A position takes the low
#: bits of an ordering key.
CHUNK_BYTES, POSITION_BITS = 2 << 20, 22
#: Text of one index, and the distinct text of one anchor from which it is counted instead.
INDEX_BYTES, HOT_BYTES = 1 << 20, 1 << 20
#: Pieces whose windows are listed at once.
LISTED_PIECES = 512

_PIECES = "anchor long, digest long, text_key long, text_bytes int, start int, length int"


_BYTE_CODES = scramble(np.arange(256, dtype=np.uint64))


def find_pieces(data: np.ndarray, bounds: np.ndarray, length: int, anchor: int) -> tuple[np.ndarray, ...]:
    """Pieces of texts laid end to end in ``data``; text t is ``data[bounds[t]:bounds[t + 1]]``.

    Returns each piece's anchor hash, text number, start in ``data`` and length.
    """
    n, window = len(data), length - anchor + 1
    empty = np.empty(0, np.int64)
    if n < length:
        return empty, empty, empty, empty
    up, down = powers(n + 1)
    sums = np.zeros(n + 1, np.uint64)
    np.cumsum(_BYTE_CODES[data] * up[:n], out=sums[1:])
    hashes = scramble((sums[anchor:] - sums[: n - anchor + 1]) * down[: n - anchor + 1])
    low = np.uint64((1 << POSITION_BITS) - 1)
    keys = (hashes & ~low) | np.arange(len(hashes), dtype=np.uint64)
    least, width = keys, 1
    while 2 * width <= window:
        least = np.minimum(least[:-width], least[width:])
        width *= 2
    if width < window:
        least = np.minimum(least[: len(least) - (window - width)], least[window - width :])
    place = (least & low).astype(np.int64)  # of the anchor of the window at each position
    inside = np.zeros(n + 1, np.int32)
    long = np.flatnonzero(np.diff(bounds) >= length)
    np.add.at(inside, bounds[long], 1)
    np.add.at(inside, bounds[long + 1] - length + 1, -1)
    inside = np.cumsum(inside)[: len(place)] > 0
    first = inside.copy()
    first[1:] &= ~inside[:-1] | (place[1:] != place[:-1])
    starts = np.flatnonzero(first)
    # A piece ends with the last position before the next piece or before the text's last window.
    ends_inside = np.flatnonzero(inside & np.r_[~inside[1:] | first[1:], True])
    texts = np.searchsorted(bounds, starts, side="right") - 1
    return hashes[place[starts]].view(np.int64), texts, starts, ends_inside - starts + length


def _piece_digest(data: memoryview) -> int:
    return int.from_bytes(hashlib.blake2b(data, digest_size=8).digest(), "little", signed=True)


def pieces(texts: DataFrame, length: int, anchor: int) -> DataFrame:
    """All pieces of ``texts`` (``text``, ``text_key``, ``text_bytes``)."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            held: list[tuple[bytes, int, int, int]] = []
            size = 0
            values = batch.column("text").cast(pa.binary()).to_pylist()
            for value, key in zip(values, batch.column("text_key").to_pylist()):
                # Parts overlap by less than a window, so that every window is in one of them.
                for offset in range(0, max(1, len(value) - length + 1), CHUNK_BYTES):
                    part = value[offset : offset + CHUNK_BYTES + length - 1]
                    if held and size + len(part) > CHUNK_BYTES:
                        yield from cut_chunk(held)
                        held, size = [], 0
                    held.append((part, key, len(value), offset))
                    size += len(part)
            yield from cut_chunk(held)

    def cut_chunk(held: list[tuple[bytes, int, int, int]]) -> Iterator[pa.RecordBatch]:
        joined = b"".join(part for part, *_ in held)
        bounds = np.r_[0, np.cumsum([len(part) for part, *_ in held])]
        keys, sizes, offsets = (np.array([row[k] for row in held], np.int64) for k in (1, 2, 3))
        hashes, owner, starts, lengths = find_pieces(np.frombuffer(joined, np.uint8), bounds, length, anchor)
        if not len(starts):
            return
        view = memoryview(joined)
        digests = [_piece_digest(view[s : s + k]) for s, k in zip(starts.tolist(), lengths.tolist())]
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(hashes),
                pa.array(digests, pa.int64()),
                pa.array(keys[owner]),
                pa.array(sizes[owner].astype(np.int32)),
                pa.array((starts - bounds[owner] + offsets[owner]).astype(np.int32)),
                pa.array(lengths.astype(np.int32)),
            ],
            names=["anchor", "digest", "text_key", "text_bytes", "start", "length"],
        )

    return texts.select("text", "text_key").mapInArrow(cut, _PIECES)


class RunIndex:
    """Run-compressed Burrows-Wheeler transform of a list of texts, with sampled run ends."""

    SYMBOLS, SYMBOL_BITS = 7, 9  # symbols compared at once

    def __init__(self, texts: Sequence[bytes]) -> None:
        sizes = np.fromiter(map(len, texts), np.int64, len(texts))
        self.starts = np.r_[0, np.cumsum(sizes + 1)[:-1]] if len(texts) else np.empty(0, np.int64)
        # Bytes are symbols 1 to 256; every text ends in a separator, 0, unlike any other one.
        symbols = np.frombuffer(b"\0".join(texts) + b"\0", np.uint8).astype(np.uint64) + np.uint64(1)
        ends = self.starts + sizes
        symbols[ends] = 0
        self.symbols, self.size = symbols, len(symbols)
        self.left = np.repeat(ends, sizes + 1) - np.arange(self.size)  # symbols up to the separator
        self.packed = self._pack()
        order = self._suffix_order()
        before = symbols[order - 1]
        before[order == 0] = 0
        # Separators differ from one another, so each is a run of its own.
        new_run = np.r_[True, (before[1:] != before[:-1]) | (before[1:] == 0)]
        heads = np.flatnonzero(new_run)
        tails = np.r_[heads[1:], self.size] - 1
        self.run_symbols, self.run_lengths = before[heads], tails - heads + 1
        self.head_positions, self.tail_positions = order[heads], order[tails]

    def _pack(self) -> np.ndarray:
        """The next symbols of each position, none after the separator, in one integer."""
        padded = np.r_[self.symbols, np.zeros(self.SYMBOLS, np.uint64)]
        packed = np.zeros(self.size, np.uint64)
        for step in range(self.SYMBOLS):
            here = np.where(self.left >= step, padded[step : step + self.size], np.uint64(0))
            packed = (packed << np.uint64(self.SYMBOL_BITS)) | here
        return packed

    def _suffix_order(self) -> np.ndarray:
        """Positions in the order of their suffixes, by doubling the compared length."""
        order = np.argsort(self.packed)
        closed = self.left < self.SYMBOLS
        # Suffixes that meet their separators at once are ordered by where these are.
        at = np.flatnonzero(closed[order])
        among = order[at]
        order[at] = among[np.lexsort((among, self.packed[among]))]
        sorted_keys = self.packed[order]
        step = np.r_[False, (sorted_keys[1:] != sorted_keys[:-1]) | closed[order[1:]]]
        compared = self.SYMBOLS
        while True:
            rank = np.empty(self.size, np.uint64)
            rank[order] = np.cumsum(step, dtype=np.uint64)
            if int(rank[order[-1]]) == self.size - 1:
                return order
            # Ranks that are not unique yet belong to suffixes that go on for that long.
            later = np.zeros(self.size, np.uint64)
            later[: self.size - compared] = rank[compared:]
            keys = (rank << np.uint64(32)) | later
            order = np.argsort(keys)
            sorted_keys = keys[order]
            step = np.r_[False, sorted_keys[1:] != sorted_keys[:-1]]
            compared *= 2

    def _common(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Length of the common prefix of the suffixes at ``a`` and ``b``, separators excluded."""
        limit = np.minimum(self.left[a], self.left[b])
        common = np.zeros(len(a), np.int64)
        open_ = np.flatnonzero(limit > 0)
        while len(open_):
            x, y = a[open_] + common[open_], b[open_] + common[open_]
            differ = self.packed[x] ^ self.packed[y]
            same = differ == 0
            bits = np.frexp(np.maximum(differ, np.uint64(1)).astype(np.float64))[1]
            # A carry in rounding can only look one bit longer, never across a symbol that is equal.
            bits -= (differ >> np.maximum(bits - 1, 0).astype(np.uint64)) == 0
            agreed = np.where(same, self.SYMBOLS, self.SYMBOLS - 1 - (np.maximum(bits, 1) - 1) // self.SYMBOL_BITS)
            common[open_] += agreed
            open_ = open_[same & (common[open_] < limit[open_])]
        return np.minimum(common, limit)

    def matching_statistics(self) -> np.ndarray:
        """Per position the longest match that also starts at another position.

        It is the match with one of the two neighbours in suffix order. Away from a run's head
        the match with the neighbour before is one shorter than at the byte before, and
        likewise at a run's tail for the neighbour after.
        """
        heads, tails = self.head_positions, self.tail_positions
        return np.maximum(
            self._streamed(heads[1:], tails[:-1], heads[0]), self._streamed(tails[:-1], heads[1:], tails[-1])
        )

    def _streamed(self, sampled: np.ndarray, neighbours: np.ndarray, alone: int) -> np.ndarray:
        """Match lengths at all positions from those at the samples; ``alone`` has no neighbour."""
        lengths = np.full(self.size, -1, np.int64)
        lengths[sampled] = self._common(sampled, neighbours)
        lengths[alone] = 0
        here = np.arange(self.size)
        # The first position of every text is a sample: a separator comes before it.
        sample = np.maximum.accumulate(np.where(lengths >= 0, here, 0))
        return lengths[sample] - (here - sample)

    def repeats(self, length: int) -> list[list[tuple[int, int]]]:
        """Per text the spans covered by strings of ``length`` bytes that start elsewhere too."""
        hit = np.flatnonzero(self.matching_statistics() >= length)
        spans: list[list[tuple[int, int]]] = [[] for _ in self.starts]
        if not len(hit):
            return spans
        owner = np.searchsorted(self.starts, hit, side="right") - 1
        new = np.r_[True, (hit[1:] > hit[:-1] + length) | (owner[1:] != owner[:-1])]
        first, last = hit[new], hit[np.r_[new[1:], True]]
        for text, begin, end in zip(owner[new], first, last):
            offset = self.starts[text]
            spans[text].append((int(begin - offset), int(end - offset + length)))
        return spans


def merge_spans(spans: Sequence[tuple[int, int]]) -> list[tuple[int, int]]:
    """Overlapping and touching spans joined, in order."""
    merged: list[list[int]] = []
    for start, end in sorted(spans):
        if merged and start <= merged[-1][1]:
            merged[-1][1] = max(merged[-1][1], end)
        else:
            merged.append([start, end])
    return [(start, end) for start, end in merged]


_SPANS = "spans array<struct<start: int, end: int>>"
_ARROW_SPANS = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))


def _span_array(rows: list[list[tuple[int, int]]]) -> pa.Array:
    return pa.array([[{"start": a, "end": b} for a, b in spans] for spans in rows], type=_ARROW_SPANS)


def _indexed(classes: DataFrame, length: int) -> DataFrame:
    """Spans of ``classes`` (``anchor``, ``digest``, ``piece``), one index after the other."""

    def mark(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[int, int, bytes]] = []
        size = 0
        for batch in batches:
            for row in zip(*(batch.column(name).to_pylist() for name in ("anchor", "digest", "piece"))):
                if size >= INDEX_BYTES and row[0] != held[-1][0]:
                    yield settle(held)
                    held, size = [], 0
                held.append(row)
                size += len(row[2])
        if held:
            yield settle(held)

    def settle(held: list[tuple[int, int, bytes]]) -> pa.RecordBatch:
        spans = RunIndex([piece for _, _, piece in held]).repeats(length)
        anchors, digests = (pa.array([row[k] for row in held], pa.int64()) for k in (0, 1))
        return pa.RecordBatch.from_arrays([anchors, digests, _span_array(spans)], ["anchor", "digest", "spans"])

    return classes.mapInArrow(mark, f"anchor long, digest long, {_SPANS}")


def _counted(classes: DataFrame, length: int) -> DataFrame:
    """The same by grouping every window: for anchors with very many distinct pieces."""

    def windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (b.slice(k, LISTED_PIECES) for b in batches for k in range(0, b.num_rows, LISTED_PIECES)):
            out: tuple[list, ...] = ([], [], [], [])
            for anchor, digest, piece in zip(*(batch.column(c).to_pylist() for c in ("anchor", "digest", "piece"))):
                for start in range(len(piece) - length + 1):
                    window = hashlib.blake2b(piece[start : start + length], digest_size=16).digest()
                    for column, value in zip(out, (anchor, digest, start, window)):
                        column.append(value)
            kinds = (pa.int64(), pa.int64(), pa.int32(), pa.binary())
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(out, kinds)], ["anchor", "digest", "start", "window"])

    all_windows = materialize(classes.mapInArrow(windows, "anchor long, digest long, start int, window binary"))
    # Pieces are distinct, so a window that comes up twice starts at two places.
    repeated = all_windows.groupBy("window").count().filter("count > 1").select("window")
    ends = (F.col("start") + length).cast("int").alias("end")
    return (
        all_windows.join(repeated, "window")
        .groupBy("anchor", "digest")
        .agg(F.collect_list(F.struct("start", ends)).alias("spans"))
    )


def _piece_texts(texts: DataFrame, reps: DataFrame) -> DataFrame:
    """``anchor``, ``digest`` and bytes of the pieces listed per text in ``reps``, a written table."""
    wanted = reps.select("text_key", "text_bytes")
    # One row per text: copies of it are dropped before and after the shuffle.
    chosen = (
        texts.join(bounded(wanted), ["text_key", "text_bytes"], "left_semi")
        .groupBy("text_key", "text_bytes")
        .agg(F.first("text").alias("text"))
        .join(reps, ["text_key", "text_bytes"])
        .select("text", "pieces")
    )

    def extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: tuple[list, ...] = ([], [], [])
            values = batch.column("text").cast(pa.binary()).to_pylist()
            for value, listed in zip(values, batch.column("pieces").to_pylist()):
                for piece in listed:
                    out[0].append(piece["anchor"])
                    out[1].append(piece["digest"])
                    out[2].append(value[piece["start"] : piece["start"] + piece["length"]])
            kinds = (pa.int64(), pa.int64(), pa.binary())
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(out, kinds)], ["anchor", "digest", "piece"])

    return chosen.mapInArrow(extract, "anchor long, digest long, piece binary")


def repeated_spans(
    texts: DataFrame, length: int = LENGTH, anchor: int = ANCHOR, index_bytes: int = INDEX_BYTES, hot_bytes: int = HOT_BYTES
) -> DataFrame:
    """``text_key``, ``text_bytes`` and merged ``spans`` of every text that has repeats."""
    cut = pieces(texts, length, anchor)
    anchors = cut.groupBy("anchor").agg(
        F.count(F.lit(1)).alias("times"), F.min("digest").alias("low"), F.max("digest").alias("high")
    )
    anchors = anchors.filter("times > 1").select("anchor", (F.col("low") != F.col("high")).alias("mixed"))
    where = ["text_key", "text_bytes", "start", "length"]
    placed = materialize(
        cut.join(anchors, "anchor").groupBy("anchor", "digest", "mixed", *where).agg(F.count(F.lit(1)).alias("times"))
    )
    whole = [F.col("start"), (F.col("start") + F.col("length")).alias("end")]
    settled = placed.filter("NOT mixed").select("text_key", "text_bytes", *whole)
    # Distinct pieces of anchors with several, each with one place to read it from.
    classes = materialize(
        placed.filter("mixed")
        .groupBy("anchor", "digest")
        .agg(F.sum("times").alias("times"), F.min(F.struct(*where)).alias("place"))
    )
    copies = classes.filter("times > 1").select("anchor", "digest")
    single = classes.filter("times = 1").select("anchor", "digest")
    listed = classes.groupBy("place.text_key", "place.text_bytes").agg(
        F.collect_list(F.struct("anchor", "digest", "place.start", "place.length")).alias("pieces")
    )
    fetched = materialize(_piece_texts(texts, materialize(listed)))
    sizes = materialize(fetched.groupBy("anchor").agg(F.sum(F.octet_length("piece")).alias("bytes")))
    hot = materialize(sizes.filter(F.col("bytes") > hot_bytes).select("anchor"))
    usual = fetched.join(hot, "anchor", "left_anti")
    total = sizes.agg(F.sum("bytes")).first()[0] or 0
    usual = usual.repartition(max(1, -(-total // index_bytes)), "anchor").sortWithinPartitions("anchor")
    marked = _indexed(usual, length)
    if not hot.isEmpty():
        marked = marked.unionByName(_counted(fetched.join(hot, "anchor", "left_semi"), length))
    # A piece that occurs twice goes whole; of a single one, what the index has marked.
    places = placed.filter("mixed").select("anchor", "digest", *where)
    twice = places.join(copies, ["anchor", "digest"]).select("text_key", "text_bytes", *whole)
    spans = marked.join(single, ["anchor", "digest"], "left_semi").filter(F.size("spans") > 0)
    found = places.join(spans, ["anchor", "digest"]).select("text_key", "text_bytes", "start", F.explode("spans").alias("span"))
    partly = found.select(
        "text_key", "text_bytes", (F.col("start") + F.col("span.start")).alias("start"), (F.col("start") + F.col("span.end")).alias("end")
    )
    gathered = (
        settled.unionByName(twice)
        .unionByName(partly)
        .groupBy("text_key", "text_bytes")
        .agg(F.collect_set(F.struct("start", "end")).alias("spans"))
    )

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [merge_spans([(s["start"], s["end"]) for s in spans]) for spans in batch.column("spans").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column("text_key"), batch.column("text_bytes"), _span_array(rows)], ["text_key", "text_bytes", "spans"]
            )

    return gathered.mapInArrow(merge, f"text_key long, text_bytes int, {_SPANS}")


def keyed_texts(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    value = F.coalesce(F.col(text), F.lit(""))
    return docs.select(
        F.col(key).alias("id"), value.alias("text"), F.xxhash64(value).alias("text_key"), F.octet_length(value).alias("text_bytes")
    )


def repeat_report(docs: DataFrame, length: int = LENGTH, **limits) -> DataFrame:
    """Per document its bytes, bytes and spans removed, and the digest of what is left."""
    texts = keyed_texts(docs)
    spans = materialize(repeated_spans(texts, length, **limits))
    rows, count = spans.agg(F.count(F.lit(1)), F.sum(F.size("spans"))).first()
    joined = texts.join(bounded(spans, max(rows, count or 0)), ["text_key", "text_bytes"], "left").select("id", "text", "spans")

    def remove(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: tuple[list, ...] = ([], [], [], [])
            values = batch.column("text").cast(pa.binary()).to_pylist()
            for value, gone in zip(values, batch.column("spans").to_pylist()):
                kept, at = hashlib.sha256(), 0
                for span in gone or ():
                    kept.update(value[at : span["start"]])
                    at = span["end"]
                kept.update(value[at:])
                removed = sum(span["end"] - span["start"] for span in gone or ())
                for column, result in zip(out, (len(value), removed, len(gone or ()), kept.hexdigest())):
                    column.append(result)
            kinds = (pa.int64(), pa.int64(), pa.int64(), pa.string())
            names = ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"]
            yield pa.RecordBatch.from_arrays([batch.column("id"), *(pa.array(c, k) for c, k in zip(out, kinds))], names)

    kind = docs.schema["doc_id"].dataType.simpleString()
    return joined.mapInArrow(remove, f"doc_id {kind}, n_bytes long, n_removed long, n_spans long, kept_sha256 string")
