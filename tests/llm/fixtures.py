"""Small awkward tables and brute-force versions of the operators' contracts."""

from __future__ import annotations

import hashlib
import random
import re
import zlib
from collections import Counter

WORDS = re.compile(r"[^\x20\x09-\x0D]+")
BENCH_WORDS = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")

#: Names that the operators use for columns of their own.
CLASHING = ("row", "hits", "shard", "slot", "size", "key", "kept_id", "scan_row", "text_key", "rejected_by", "copies")
DOC_SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def prose(seed: int, words: int, vocabulary: int = 400) -> str:
    rng = random.Random(seed)
    return " ".join(f"w{rng.randrange(vocabulary):x}{'é' if rng.random() < 0.05 else ''}" for _ in range(words))


def edited(text: str, seed: int, changes: int) -> str:
    rng, words = random.Random(seed), text.split(" ")
    for _ in range(changes):
        words[rng.randrange(len(words))] = f"new{rng.randrange(10**6)}"
    return " ".join(words)


def awkward_rows() -> list[tuple]:
    """Documents with NULLs, empty and long texts, ties, copies, near copies and repeated rows."""
    base = [prose(seed, 120) for seed in range(6)]
    texts = [
        None,
        "",
        " \t\n ",
        "one",
        "One",
        "two words",
        *base,
        base[0],
        base[0].upper(),
        edited(base[1], 1, 4),
        edited(base[1], 2, 4),
        edited(edited(base[1], 1, 4), 3, 6),
        edited(base[2], 4, 1) + "\n" + base[3],
        "\n".join(["same line of text"] * 40),
        "# $ % & | < >" * 30,
        prose(77, 6000),
        prose(77, 6000) + " tail",
    ]
    sources = [None, "a", "b", "", "c", "a"]
    rows = [(k, text, "en" if k % 3 else None, sources[k % len(sources)], None) for k, text in enumerate(texts)]
    return [*rows, rows[6], (None, base[4], "en", None, 3), (None, None, None, None, None)]


def awkward(spark, rows=None):
    """The rows with extra columns that clash with the operators' own."""
    schema = ", ".join([DOC_SCHEMA, *(f"{name} string" for name in CLASHING)])
    made = [(*row, *("x" for _ in CLASHING)) for row in (awkward_rows() if rows is None else rows)]
    return spark.createDataFrame(made, schema)


def scanned(spark, df):
    """The frame as a plain scan of written files."""
    from tallyforge.sources.storage import materialize

    return materialize(df)


def lower(text: str) -> str:
    return re.sub("[A-Z]", lambda m: chr(ord(m[0]) + 32), text)


def words(text: str | None) -> list[str]:
    return WORDS.findall(text or "")


def counts(text: str | None) -> tuple[int, int, int, int, int]:
    text, found = text or "", words(text)
    lines, seen, dup = text.split("\n"), set(), 0
    for line in lines:
        if words(line):
            dup += line in seen
            seen.add(line)
    windows = Counter(zip(found, found[1:], found[2:]))
    repeated = set()
    for k in range(len(found) - 2):
        if windows[tuple(found[k : k + 3])] > 1:
            repeated |= {k, k + 1, k + 2}
    return len(found), sum(map(len, found)), sum(c in "#*$%&|<>" for c in text), dup, len(repeated)


def shingles(text: str | None, size: int) -> frozenset:
    found = words(lower(text or ""))
    if not found:
        return frozenset()
    if len(found) < size:
        return frozenset([tuple(found)])
    return frozenset(tuple(found[k : k + size]) for k in range(len(found) - size + 1))


def near_components(rows: list[tuple[int, str | None]], size: int, percent: int) -> dict[int, int]:
    sets = {key: shingles(text, size) for key, text in rows}
    parent = {key: key for key in sets}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    keys = sorted(sets)
    for n, a in enumerate(keys):
        for b in keys[:n]:
            common = len(sets[a] & sets[b])
            if common and 100 * common >= percent * (len(sets[a]) + len(sets[b]) - common):
                x, y = sorted((find(a), find(b)))
                parent[y] = x
    return {key: find(key) for key in keys}


def contamination(text: str | None, benchmark: list[tuple], window: int = 13) -> tuple:
    found = BENCH_WORDS.findall(lower(text or ""))
    hit, items = set(), set()
    for item, item_text in benchmark:
        own = BENCH_WORDS.findall(lower(item_text or ""))
        size = min(window, len(own))
        windows = {tuple(own[k : k + size]) for k in range(len(own) - size + 1)} if own else set()
        for k in range(len(found) - size + 1):
            if windows and tuple(found[k : k + size]) in windows:
                hit |= set(range(k, k + size))
                if item is not None:
                    items.add(str(item))
    digest = hashlib.sha256(",".join(sorted(items)).encode()).hexdigest()
    return len(found), len(hit), len(items), digest, len(hit) > 0 and 20 * len(hit) >= len(found)


def removed(texts: list[str | None], length: int) -> list[tuple[int, int, int, str]]:
    data = [(text or "").encode() for text in texts]
    seen = Counter(value[k : k + length] for value in data for k in range(len(value) - length + 1))
    out = []
    for value in data:
        gone = bytearray(len(value) + 1)
        for k in range(len(value) - length + 1):
            if seen[value[k : k + length]] > 1:
                gone[k : k + length] = b"\1" * length
        spans = sum(gone[k] and not gone[k - 1] for k in range(len(value)))
        kept = bytes(b for k, b in enumerate(value) if not gone[k])
        out.append((len(value), sum(gone), spans, hashlib.sha256(kept).hexdigest()))
    return out


def crc(text: str | None) -> int:
    return zlib.crc32((text or "").encode())
