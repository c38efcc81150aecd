from __future__ import annotations

import math
import zlib
from collections import Counter

import numpy as np
import pytest

import fixtures
from tallyforge.llm import lm


def base_scores(rows):
    held = [key is not None and zlib.crc32(str(key).encode()) % 5 == 1 for key, *_ in rows]
    tokens = [fixtures.words(fixtures.lower(text or "")) + [""] for _, text, *_ in rows]
    counts = Counter(token for own, out in zip(tokens, held) if not out for token in own)
    total, kinds = sum(counts.values()), len(counts)
    out = []
    for (key, *_), own, is_held in zip(rows, tokens, held):
        score = sum(math.log10((counts[t] + 0.5) / (total + 0.5 * (kinds + 1))) for t in own)
        out.append((key, is_held, len(own), sum(counts[t] > 0 for t in own), total, round(score, 6)))
    return sorted(out, key=repr)


@pytest.mark.parametrize("head", [1 << 17, 5])
def test_base_columns_equal_brute_force(spark, monkeypatch, head):
    monkeypatch.setattr(lm, "HEAD_WORDS", head)
    rows = fixtures.awkward_rows()
    got = lm.score_report(fixtures.awkward(spark)).collect()
    assert sorted((tuple(row)[:5] + (round(row.base_score, 6),) for row in got), key=repr) == base_scores(rows)
    assert all(row.score < 0 and math.isfinite(row.score) for row in got)
    assert len({row.score for row in got if row.doc_id in (0, 1)}) == 1


def test_learned_texts_are_likelier_than_noise(spark):
    rows = [(k, fixtures.prose(k, 150, 60), None, None, None) for k in range(60)]
    rows += [(1000 + k, "".join(chr(33 + (k * 31 + n * n * 7) % 90) for n in range(600)), None, None, None) for k in range(3)]
    got = {row.doc_id: row for row in lm.score_report(fixtures.awkward(spark, rows)).collect()}
    held = [row for key, row in got.items() if key < 1000 and row.held_out]
    assert held and all(row.bits_per_byte < 2.5 for row in held)
    noisy = [got[1000 + k].bits_per_byte for k in range(3) if got[1000 + k].held_out]
    assert all(bits > 2.5 for bits in noisy)


def test_nothing_to_learn_from(spark):
    only_held = next(k for k in range(100) if zlib.crc32(str(k).encode()) % 5 == 1)
    for rows in ([], [(only_held, "some text", None, None, None)]):
        got = lm.score_report(fixtures.awkward(spark, rows)).collect()
        assert len(got) == len(rows) and all(row.train_tokens == 0 and row.score < 0 for row in got)


def small_model():
    texts = [fixtures.prose(k, 80, 30).encode() for k in range(20)]
    strings, counts = np.unique(np.concatenate([lm.symbol_strings(p)[0] for p in lm._chunks(texts)]), return_counts=True)
    symbols = Counter()
    for string, count in zip(strings & 511, counts):
        symbols[int(string)] += int(count)
    code = lm.huffman(symbols)
    table = np.zeros((lm.SLOT_OFFSETS[-1], 2), np.float32)
    owner, bit, slots = lm.decisions(strings, code)
    for context, slot in enumerate(slots):
        np.add.at(table, (slot + lm.SLOT_OFFSETS[context], bit), counts[owner])
    return texts, code, lm.Predictors.of(table)


def test_probabilities_of_the_next_symbol_sum_to_one():
    _, code, table = small_model()
    context = lm.symbol_strings(next(lm._chunks([b"w1 w2 w"])))[0][4] & ~511
    costs = lm.string_costs(context | np.arange(lm.SYMBOLS), code, table, lm.first_weights())
    assert np.exp(costs).sum(axis=1) == pytest.approx([1.0] * len(lm.MIXERS))


def test_scores_do_not_depend_on_how_texts_are_cut(monkeypatch):
    texts, code, table = small_model()
    texts = [*texts, b" ".join(texts), b"", b"x" * 128, b"x" * 3000]
    whole = lm.text_log_probabilities(texts, code, table, lm.first_weights())
    monkeypatch.setattr(lm, "CHUNK_BYTES", lm.BLOCK_BYTES + 64)
    monkeypatch.setattr(lm, "LOOK_BACK", 4096)
    assert sum(map(len, lm._chunks(texts))) > len(texts) + 10
    cut = lm.text_log_probabilities(texts, code, table, lm.first_weights())
    assert cut == pytest.approx(whole)


def test_codes_are_prefix_free():
    code = lm.huffman({97: 1000, 98: 10})
    paths = {tuple(zip(code.nodes[a:b], code.bits[a:b])) for a, b in zip(code.begin[:-1], code.begin[1:])}
    assert len(paths) == lm.SYMBOLS
    assert sum(2.0 ** -(b - a) for a, b in zip(code.begin[:-1], code.begin[1:])) == pytest.approx(1)


MASK = (1 << 64) - 1
ODD = 0x9E3779B97F4A7C15


def mix64(x):
    return int(lm.scramble(np.array([x & MASK], np.uint64))[0])


def plain_strings(text):
    """Symbol, its last one to three symbols, and the hash of the word so far, byte by byte."""
    symbols = [*text, lm.END]
    word_begin, out = 0, []
    for i, symbol in enumerate(symbols):
        before = [symbols[i - k] if i >= k else lm.START for k in (1, 2, 3)]
        word = sum(mix64(text[j]) * pow(ODD, j - word_begin, 1 << 64) for j in range(word_begin, i)) & MASK
        contexts = [before[0], before[0] | before[1] << 9, before[0] | before[1] << 9 | before[2] << 18]
        out.append((symbol, (*contexts, ((word * ODD) & MASK) >> 37)))
        if i < len(text) and text[i : i + 1].isspace():
            word_begin = i + 1
    return out


def plain_blocks(text):
    """How many symbols each block has."""
    sizes, size = [], 0
    for i in range(len(text) + 1):
        size += 1
        window = sum(text[i - k] << 8 * (8 - k) for k in range(1, 9) if i >= k)
        cut = i < len(text) and text[i : i + 1].isspace() and mix64(window) % lm.BLOCK_WORDS == 0
        if cut or size == lm.BLOCK_BYTES or i == len(text):
            sizes.append(size)
            size = 0
    return sizes


def plain_scores(texts, held_out, weights):
    strings = [plain_strings(text) for text in texts]
    learned = [own for own, out in zip(strings, held_out) if not out]
    code = lm.huffman(Counter(symbol for own in learned for symbol, _ in own))

    def steps(symbol, contexts):
        for at in range(code.begin[symbol], code.begin[symbol + 1]):
            slots = []
            for k, (context, bits) in enumerate(zip(contexts, lm.TABLE_BITS)):
                mixed = mix64(context + (k << 50)) ^ int(code.nodes[at])
                slots.append((k, ((mixed * ODD) & MASK) >> (64 - bits)))
            yield slots, int(code.bits[at])

    counts = Counter()
    for own in learned:
        for symbol, contexts in own:
            for slots, bit in steps(symbol, contexts):
                counts.update((slot, bit) for slot in slots)

    def cost(mixer, symbol, contexts):
        total = 0.0
        for slots, bit in steps(symbol, contexts):
            odds = [math.log((counts[s, 1] + 0.4) / (counts[s, 0] + 0.4)) for s in slots]
            level = [min(3, int(math.log2(1 + counts[s, 0] + counts[s, 1]) / 3)) for s in slots]
            gate = level[2] * 4 + level[3]
            z = sum(o * w * use for o, w, use in zip(odds, weights[mixer, gate], lm.MIXERS[mixer]))
            total -= math.log1p(math.exp(-z if bit else z))
        return total

    cut = []
    for text in texts:
        ends = np.cumsum(plain_blocks(text)).tolist()
        whole = [*text, lm.END]
        cut.append([(tuple(whole[a:b]), a, b) for a, b in zip([0, *ends], ends)])
    blocks = Counter(block for own, out in zip(cut, held_out) if not out for block, *_ in own)
    scores = []
    for own, out, string in zip(cut, held_out, strings):
        mine = Counter() if out else Counter(block for block, *_ in own)
        total = blocks.total() - mine.total()
        shares, score = [1 / 3] * 3, 0.0
        for block, a, b in own:
            chances = [math.exp(sum(cost(m, *string[i]) for i in range(a, b))) for m in range(2)]
            chances.append((blocks[block] - mine[block] + sum(chances) / 2) / (total + 1))
            gained = sum(s * c for s, c in zip(shares, chances))
            score += math.log10(gained)
            shares = [0.98 * s * c / gained + 0.02 / 3 for s, c in zip(shares, chances)]
        scores.append(score)
    return scores


@pytest.mark.parametrize("head", [1 << 18, 1])
def test_scores_equal_brute_force(spark, monkeypatch, head):
    weights = np.random.default_rng(5).uniform(0.1, 0.7, (len(lm.MIXERS), lm.GATES, lm.CONTEXTS))
    weights *= np.array(lm.MIXERS)[:, None, :]
    monkeypatch.setattr(lm, "train_weights", lambda *_: weights)
    monkeypatch.setattr(lm, "HEAD_BLOCKS", head)
    shared = fixtures.prose(3, 60, 40)
    texts = [fixtures.prose(k, 25, 30) for k in range(8)]
    texts += [shared, shared, "other words first " + shared, "", "", "x" * 700, "\u00e9t\u00e9 \u4e2d\u6587\ttab\n"]
    rows = [(k, text, None, None, None) for k, text in enumerate(texts)]
    held_out = [zlib.crc32(str(k).encode()) % 5 == 1 for k in range(len(texts))]
    got = {row.doc_id: row.score for row in lm.score_report(fixtures.awkward(spark, rows)).collect()}
    want = plain_scores([text.encode() for text in texts], held_out, weights)
    assert [got[k] for k in range(len(texts))] == pytest.approx(want, rel=1e-4)


def test_texts_that_occur_twice_are_likelier(spark):
    texts = [fixtures.prose(k, 200, 5000) for k in range(60)]
    texts += texts[:10]
    rows = [(k, text, None, None, None) for k, text in enumerate(texts)]
    held_out = [zlib.crc32(str(k).encode()) % 5 == 1 for k in range(len(texts))]
    got = {row.doc_id: row.bits_per_byte for row in lm.score_report(fixtures.awkward(spark, rows)).collect()}
    other = {k: (k + 60 if k < 10 else k - 60) for k in [*range(10), *range(60, 70)]}
    known = [got[k] for k, twin in other.items() if not held_out[twin]]
    assert known and max(known) < 0.5 * min(got[k] for k in range(10, 60))
