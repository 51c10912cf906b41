"""Dense statistics of whole texts, computed over Arrow buffers for all texts of a block at once."""

from __future__ import annotations

import numpy as np

from shelfline.llm.textbuf import (
    LOWER_VALUES, SPACE, Block, mix, prefix_sums, row_bounds, span_hashes, spans, word_hash,
)

CLASSES = 14
LOWER, UPPER, DIGIT, BLANK, NEWLINE, WHITE, STOP, COMMA, SHOUT, ASK, SYMBOL, LEAD, TAIL, REST = range(CLASSES)


def _class_table() -> np.ndarray:
    table = np.full(256, REST, np.uint8)
    table[97:123], table[65:91], table[48:58] = LOWER, UPPER, DIGIT
    table[9:14] = WHITE
    table[128:192], table[192:] = TAIL, LEAD
    for mark, kind in ((b" ", BLANK), (b"\n", NEWLINE), (b".", STOP), (b",", COMMA), (b"!", SHOUT), (b"?", ASK), (b"#*$%&|<>", SYMBOL)):
        table[list(mark)] = kind
    return table


CLASS = _class_table()


def class_counts(block: Block) -> np.ndarray:
    """Bytes of each class per row."""
    row = np.repeat(np.arange(block.rows) * CLASSES, np.diff(block.offsets))
    return np.bincount(row + CLASS[block.data], minlength=block.rows * CLASSES).reshape(block.rows, CLASSES).astype(float)


def per_row(rows: np.ndarray, n: int, weights: np.ndarray | None = None) -> np.ndarray:
    return np.bincount(rows, weights, n).astype(float)


def repeated(keys: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """Which items have an equal item in the same row; rows ascend."""
    order = np.lexsort((keys, rows))
    k, r = keys[order], rows[order]
    same = (k[1:] == k[:-1]) & (r[1:] == r[:-1])
    out = np.zeros(len(keys), bool)
    out[order[1:][same]] = True
    out[order[:-1][same]] = True
    return out


def line_repeats(block: Block) -> tuple[np.ndarray, np.ndarray]:
    """Lines with content per row, and those of them that occur twice or more."""
    breaks = np.zeros(256, bool)
    breaks[10] = True
    starts, ends, rows = spans(block, ~breaks)
    hashes = span_hashes(prefix_sums(block.data, LOWER_VALUES), starts, ends)
    return per_row(rows, block.rows), per_row(rows[repeated(hashes, rows)], block.rows)


def quality_features(block: Block) -> np.ndarray:
    """One row of statistics per text; texts without words have zeros where a share has no base."""
    n = block.rows
    size = np.diff(block.offsets).astype(float)
    counts = class_counts(block)
    starts, ends, rows = spans(block, ~SPACE)
    hashes = span_hashes(prefix_sums(block.data, LOWER_VALUES), starts, ends)
    n_words = per_row(rows, n)
    words = np.maximum(n_words, 1)
    letters = np.maximum(counts[:, LOWER] + counts[:, UPPER] + counts[:, LEAD], 1)
    same_before = np.zeros(len(hashes), bool)
    same_before[1:] = (hashes[1:] == hashes[:-1]) & (rows[1:] == rows[:-1])
    triples = hashes[:-2] * np.uint64(3) + hashes[1:-1] * np.uint64(5) + hashes[2:] * np.uint64(7)
    inside = rows[:-2] == rows[2:]
    again = np.zeros(len(triples), bool)
    again[inside] = repeated(mix(triples[inside]), rows[:-2][inside])
    lines, lines_twice = line_repeats(block)
    length = (ends - starts).astype(float)
    first, last = CLASS[block.data[starts]], CLASS[block.data[np.maximum(ends - 1, 0)]]
    columns = [
        np.log1p(size), np.log1p(n_words), size / words, np.log1p(lines), n_words / np.maximum(lines, 1),
        *(counts[:, k] / np.maximum(size, 1) for k in range(CLASSES)),
        counts[:, UPPER] / letters, counts[:, SYMBOL] / words, counts[:, SHOUT] / words, counts[:, STOP] / words,
        per_row(rows[same_before], n) / words,
        per_row(rows[repeated(hashes, rows)], n) / words,
        per_row(rows[:-2][again], n) / words,
        lines_twice / np.maximum(lines, 1),
        per_row(rows, n, length**2) / np.maximum(per_row(rows, n, length), 1),
        per_row(rows[first == UPPER], n) / words,
        per_row(rows[last == SYMBOL], n) / words,
        per_row(rows[last == SHOUT], n) / words,
        per_row(rows[length > 30], n) / words,
    ]
    return np.stack(columns, axis=1)


# Words that insult, and second-person words, in lower case.
INSULTS = (
    "idiot moron stupid scum trash clown loser pathetic worthless disgusting dumb fool jerk garbage imbecile "
    "idiota estúpido imbécil basura asqueroso dumm blöd abschaum idioten widerlich crétin imbécile ordure stupide"
).split()
SECOND_PERSON = "you your yours yourself u ur tu te ti tus usted vosotros du dich dir dein deine ihr euch vous toi ton ta tes votre vos".split()

TOKEN = np.zeros(256, bool)
TOKEN[[*range(48, 58), *range(65, 91), *range(97, 123), *range(128, 256)]] = True
# Inside a disguised word these stand for letters.
DISGUISE = {"0": "o", "1": "i", "3": "e", "4": "a", "5": "s", "7": "t", "@": "a", "$": "s"}
DISGUISED_VALUES = LOWER_VALUES.copy()
for _mark, _letter in DISGUISE.items():
    DISGUISED_VALUES[ord(_mark)] = LOWER_VALUES[ord(_letter)]
DISGUISED_TOKEN = TOKEN.copy()
DISGUISED_TOKEN[[ord("@"), ord("$")]] = True
STEMS = (4, 5, 6)
NEAR = 5


def hash_list(terms) -> np.ndarray:
    return np.unique(np.array([word_hash(t.encode()) for t in terms], np.uint64))


def among(keys: np.ndarray, sorted_set: np.ndarray) -> np.ndarray:
    if not len(sorted_set):
        return np.zeros(len(keys), bool)
    at = np.minimum(np.searchsorted(sorted_set, keys), len(sorted_set) - 1)
    return sorted_set[at] == keys


def terms(block: Block) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, list[tuple[np.ndarray, np.ndarray]]]:
    """Words (start, end, row, hash) and, per stem length, (word index, hash of its first bytes)."""
    starts, ends, rows = spans(block, TOKEN)
    sums = prefix_sums(block.data, LOWER_VALUES)
    stems = []
    for length in STEMS:
        longer = np.flatnonzero(ends - starts > length)
        stems.append((longer, span_hashes(sums, starts[longer], starts[longer] + length)))
    return starts, ends, rows, span_hashes(sums, starts, ends), stems


def distinct_terms(block: Block) -> tuple[np.ndarray, np.ndarray]:
    """(row, hash) of every word and stem, once per row, in row order."""
    _, _, rows, hashes, stems = terms(block)
    key = np.concatenate([hashes, *(h for _, h in stems)])
    row = np.concatenate([rows, *(rows[i] for i, _ in stems)])
    order = np.lexsort((key, row))
    key, row = key[order], row[order]
    fresh = np.ones(len(key), bool)
    fresh[1:] = (key[1:] != key[:-1]) | (row[1:] != row[:-1])
    return row[fresh], key[fresh]


INSULT_HASHES, YOU_HASHES = hash_list(INSULTS), hash_list(SECOND_PERSON)


def toxicity_features(block: Block, learnt: np.ndarray) -> np.ndarray:
    """Lexicon densities, second-person proximity, capitals, punctuation and disguise rates per text."""
    n = block.rows
    counts = class_counts(block)
    starts, ends, rows, hashes, stems = terms(block)
    n_words = per_row(rows, n)
    words = np.maximum(n_words, 1)
    insult = among(hashes, INSULT_HASHES)
    marked = among(hashes, learnt)
    for index, stem in stems:
        marked[index[among(stem, learnt)]] = True
    hit = insult | marked
    you = among(hashes, YOU_HASHES)
    # distance in words to the last second-person word of the same text, looking both ways
    place = np.arange(len(hashes))
    last = np.maximum.accumulate(np.where(you, place, -1 - NEAR)) if len(place) else place
    following = np.minimum.accumulate(np.where(you, place, len(place) + NEAR)[::-1])[::-1] if len(place) else place
    bounds = row_bounds(rows, n)
    near = ((place - last <= NEAR) & (last >= bounds[rows])) | ((following - place <= NEAR) & (following < bounds[rows + 1]))
    capital = np.concatenate([[0], np.cumsum(CLASS[block.data] == UPPER)])
    digit = np.concatenate([[0], np.cumsum(CLASS[block.data] == DIGIT)])
    length = ends - starts
    capitals, digits = capital[ends] - capital[starts], digit[ends] - digit[starts]
    loud = (capitals == length) & (length > 2)
    mixed = (digits > 0) & (digits < length)
    d_starts, d_ends, d_rows = spans(block, DISGUISED_TOKEN)
    disguised = span_hashes(prefix_sums(block.data, DISGUISED_VALUES), d_starts, d_ends)
    known = np.union1d(INSULT_HASHES, learnt)
    plain = span_hashes(prefix_sums(block.data, LOWER_VALUES), d_starts, d_ends)
    hidden = among(disguised, known) & (plain != disguised)
    hits = np.flatnonzero(hit)
    kinds = np.unique(np.stack([rows[hits].astype(np.uint64), hashes[hits]], axis=1), axis=0)[:, 0].astype(np.int64) if len(hits) else hits
    size = np.maximum(np.diff(block.offsets).astype(float), 1)
    columns = [
        np.log1p(n_words),
        per_row(rows[insult], n), per_row(rows[insult], n) / words,
        per_row(rows[marked], n), per_row(rows[marked], n) / words,
        per_row(rows[hit], n), per_row(rows[hit], n) / words, per_row(kinds, n),
        per_row(rows[you], n) / words, per_row(rows[near & hit], n) / words,
        counts[:, UPPER] / np.maximum(counts[:, UPPER] + counts[:, LOWER] + counts[:, LEAD], 1),
        per_row(rows[loud], n) / words,
        counts[:, SHOUT] / words, counts[:, ASK] / words, (counts[:, STOP] + counts[:, COMMA]) / words,
        counts[:, SYMBOL] / size, counts[:, REST] / size,
        per_row(rows[mixed], n) / words, per_row(d_rows[hidden], n),
    ]
    return np.stack(columns, axis=1)
