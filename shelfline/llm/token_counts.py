"""Token counts that follow edits: a segment tree over the pre-token runs of each document.

A text is cut into leaves of about `LEAF_CHARS` characters. Cuts lie before a single space between two
characters that are not white space; the pre-token pattern of the vocabulary never matches across
such a place, so token counts of leaves add up to the count of the whole text. The tree holds
characters and tokens per node in heap order (children of node i: 2i and 2i + 1), so an edit finds its
leaf by descending over character sums, and changed counts go up one path.

An edit replaces characters [start, stop) of the original text. Edits of one document are sorted and
those that overlap are applied as one replacement of the covered range. Only the leaves they touch are
encoded again, plus the neighbouring leaf where an edit has spoilt the cut between them.

`apply_edits` only counts; `edit_tree` returns the edited text with its tree, in which the touched runs are cut into
leaves anew, so one edit can follow another.

Defined cases: a null or empty text has one empty leaf and 0 tokens; no or null edits change
nothing; an edit past the end is cut to the text, an edit with start after stop inserts at start; rows are
independent, so repeated rows agree; an empty table gives an empty result; extra columns are not read.
"""

from __future__ import annotations

import base64
import re

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfline.llm.textbuf import kept

RANKS = "/opt/tokenizers/byte_bpe_50k.tiktoken"
# Fixed value: how this vocabulary splits text before merging.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
LEAF_CHARS = 512
# Batches of leaves sent to the encoder at once.
BATCH_LEAVES = 4096
CUT = re.compile(r"(?<=\S) (?=\S)")
# The edit that the query applies: long runs of digits are masked.
MASKED = re.compile(r"[0-9]{4,}")
MASK = "0"

LONG, LONGS = T.LongType(), T.ArrayType(T.LongType())
TREE = T.StructType().add("chars", LONGS).add("tokens", LONGS)
EDITS = T.ArrayType(T.StructType().add("start", LONG).add("stop", LONG).add("replacement", T.StringType()))
COUNTS = T.StructType().add("tokens", LONG).add("leaves", LONG).add("encoded_leaves", LONG).add("encoded_chars", LONG)


def encoder(path: str):
    return kept(f"ranks of {path}", lambda: read_encoder(path))


def read_encoder(path: str):
    import tiktoken

    with open(path, "rb") as lines:
        ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
    return tiktoken.Encoding("counts", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})


def cut_leaves(text: str, size: int = LEAF_CHARS) -> list[str]:
    leaves, at = [], 0
    while True:
        found = CUT.search(text, at + size)
        if not found:
            return [*leaves, text[at:]]
        leaves.append(text[at: found.start()])
        at = found.start()


def heap(values: list[int]) -> list[int]:
    """Sums in heap order; leaves begin at the middle. Index 0 is unused."""
    width = 1
    while width < len(values):
        width *= 2
    nodes = [0] * width + values + [0] * (width - len(values))
    for i in range(width - 1, 0, -1):
        nodes[i] = nodes[2 * i] + nodes[2 * i + 1]
    return nodes


def find_leaf(chars: list[int], place: int) -> tuple[int, int]:
    """(leaf, its first character): the leaf that holds character `place`; the last one for the end of the text."""
    width, node, before = len(chars) // 2, 1, 0
    while node < width:
        node *= 2
        # go right when the place lies behind the left half and there is text to the right
        if place - before >= chars[node] and chars[node + 1]:
            before += chars[node]
            node += 1
    return node - width, before


def set_leaf(nodes: list[int], leaf: int, value: int) -> None:
    node = len(nodes) // 2 + leaf
    change = value - nodes[node]
    while node:
        nodes[node] += change
        node //= 2


def merged_edits(edits, length: int) -> list[tuple[int, int, str]]:
    out: list[tuple[int, int, str]] = []
    for edit in sorted(edits, key=lambda e: (e["start"], e["stop"])):
        start = min(max(edit["start"], 0), length)
        stop = min(max(edit["stop"], start), length)
        if out and start < out[-1][1]:
            out[-1] = (out[-1][0], max(out[-1][1], stop), out[-1][2] + (edit["replacement"] or ""))
        else:
            out.append((start, stop, edit["replacement"] or ""))
    return out


def edited_text(text: str, edits: list[tuple[int, int, str]]) -> str:
    parts, at = [], 0
    for start, stop, replacement in edits:
        parts += [text[at:start], replacement]
        at = stop
    return "".join([*parts, text[at:]])


def touched_runs(text: str, chars: list[int], edits: list[tuple[int, int, str]]) -> list[tuple[int, int, str]]:
    """(first leaf, last leaf, new text) of each run of leaves that must be encoded again.

    A run grows over a neighbour while the cut between them is no longer a safe place.
    """
    width = len(chars) // 2
    leaves = max(1, next((i for i in range(width, 0, -1) if chars[width + i - 1]), 1))
    runs: list[list] = []
    for edit in edits:
        first, _ = find_leaf(chars, edit[0])
        last, _ = find_leaf(chars, max(edit[1] - 1, edit[0]))
        if runs and first <= runs[-1][1]:
            runs[-1][1] = max(last, runs[-1][1])
            runs[-1][2].append(edit)
        else:
            runs.append([first, last, [edit]])
    begins = [0]
    for leaf in range(leaves):
        begins.append(begins[-1] + chars[width + leaf])

    def new_text(run) -> str:
        low, high = begins[run[0]], begins[run[1] + 1]
        return edited_text(text[low:high], [(a - low, b - low, r) for a, b, r in run[2]])

    done: list[list] = []
    todo = runs[::-1]
    while todo:
        run = todo.pop()
        while True:
            body = new_text(run)
            if run[0] > 0 and (len(body) < 2 or not CUT.match(text[begins[run[0]] - 1] + body, 1)):
                run = [run[0] - 1, run[1], run[2]]
                if done and done[-1][1] >= run[0]:
                    left = done.pop()
                    run = [left[0], run[1], left[2] + run[2]]
                continue
            if run[1] + 1 < leaves and (not body or not CUT.match(body[-1] + text[begins[run[1] + 1]: begins[run[1] + 1] + 2], 1)):
                run = [run[0], run[1] + 1, run[2]]
                if todo and todo[-1][0] <= run[1]:
                    right = todo.pop()
                    run = [run[0], max(run[1], right[1]), run[2] + right[2]]
                continue
            break
        done.append([run[0], run[1], run[2], body])
    return [(first, last, body) for first, last, _, body in done]


def build_tree(text: Column, ranks: str = RANKS) -> Column:
    """The segment tree of each text."""

    @F.arrow_udf(TREE)
    def build(texts: pa.Array) -> pa.Array:
        encode = encoder(ranks)
        out, waiting = [], []

        def flush():
            counts = iter([len(ids) for ids in encode.encode_ordinary_batch([leaf for leaves in waiting for leaf in leaves], num_threads=1)])
            for leaves in waiting:
                out.append({"chars": heap([len(leaf) for leaf in leaves]), "tokens": heap([next(counts) for _ in leaves])})
            waiting.clear()

        held = 0
        for text_ in texts:
            waiting.append(cut_leaves(text_.as_py() or ""))
            held += len(waiting[-1])
            if held >= BATCH_LEAVES:
                flush()
                held = 0
        flush()
        return pa.array(out, pa.struct([("chars", pa.list_(pa.int64())), ("tokens", pa.list_(pa.int64()))]))

    return build(text.cast("string"))


def apply_edits(text: Column, tree: Column, edits: Column, ranks: str = RANKS) -> Column:
    """Token count after the edits, and how much of the text was encoded for it."""

    @F.arrow_udf(COUNTS)
    def recount(texts: pa.Array, trees: pa.Array, changes: pa.Array) -> pa.Array:
        encode = encoder(ranks)
        out = []
        for text_, tree_, change in zip(texts, trees, changes):
            known = tree_.as_py()
            chars, tokens = known["chars"], known["tokens"]
            leaves = max(1, sum(1 for c in chars[len(chars) // 2:] if c))
            runs = []
            if change.as_py():
                body = text_.as_py() or ""
                runs = touched_runs(body, chars, merged_edits(change.as_py(), len(body)))
                for (first, last, _), ids in zip(runs, encode.encode_ordinary_batch([new for *_, new in runs], num_threads=1)):
                    set_leaf(tokens, first, len(ids))
                    for leaf in range(first + 1, last + 1):
                        set_leaf(tokens, leaf, 0)
            out.append({
                "tokens": tokens[1], "leaves": leaves, "encoded_leaves": sum(last - first + 1 for first, last, _ in runs),
                "encoded_chars": sum(len(new) for *_, new in runs),
            })
        return pa.array(out, pa.struct([(name, pa.int64()) for name in ("tokens", "leaves", "encoded_leaves", "encoded_chars")]))

    return recount(text.cast("string"), tree, edits)


def edited_leaves(text: str, known: dict, edits, encode) -> tuple[str, list[int], list[int], int]:
    """(edited text, characters per leaf, tokens per leaf, leaves encoded); runs that were touched are cut into leaves anew."""
    chars, tokens = known["chars"], known["tokens"]
    width = len(chars) // 2
    n = max(1, sum(1 for c in chars[width:] if c))
    sizes, counts = chars[width: width + n], tokens[width: width + n]
    merged = merged_edits(edits, len(text))
    runs = [(first, last, cut_leaves(body)) for first, last, body in touched_runs(text, chars, merged)]
    coded = iter(encode.encode_ordinary_batch([leaf for *_, leaves in runs for leaf in leaves], num_threads=1))
    fresh = [(first, last, [len(x) for x in leaves], [len(next(coded)) for _ in leaves]) for first, last, leaves in runs]
    for first, last, new_sizes, new_counts in reversed(fresh):
        sizes[first: last + 1], counts[first: last + 1] = new_sizes, new_counts
    return edited_text(text, merged), sizes, counts, sum(len(leaves) for *_, leaves in runs)


EDITED = T.StructType().add("text", T.StringType()).add("tree", TREE).add("encoded_leaves", LONG)


def edit_tree(text: Column, tree: Column, edits: Column, ranks: str = RANKS) -> Column:
    """The edited text and its tree, ready for further edits; only the touched leaves are encoded. A null text without edits stays null."""

    @F.arrow_udf(EDITED)
    def edited(texts: pa.Array, trees: pa.Array, changes: pa.Array) -> pa.Array:
        encode = encoder(ranks)
        out = []
        for text_, tree_, change in zip(texts, trees, changes):
            known, asked = tree_.as_py(), change.as_py()
            if not asked:
                out.append({"text": text_.as_py(), "tree": known, "encoded_leaves": 0})
                continue
            body, sizes, counts, encoded = edited_leaves(text_.as_py() or "", known, asked, encode)
            out.append({"text": body, "tree": {"chars": heap(sizes), "tokens": heap(counts)}, "encoded_leaves": encoded})
        kind = pa.struct([("chars", pa.list_(pa.int64())), ("tokens", pa.list_(pa.int64()))])
        return pa.array(out, pa.struct([("text", pa.string()), ("tree", kind), ("encoded_leaves", pa.int64())]))

    return edited(text.cast("string"), tree, edits)


@F.arrow_udf(EDITS)
def digit_masks(texts: pa.Array) -> pa.Array:
    """The edits that mask every run of four digits or more."""
    kind = pa.list_(pa.struct([("start", pa.int64()), ("stop", pa.int64()), ("replacement", pa.string())]))
    return pa.array(
        [[{"start": m.start(), "stop": m.end(), "replacement": MASK} for m in MASKED.finditer(t.as_py() or "")] for t in texts], kind)


def decide(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", ranks: str = RANKS) -> DataFrame:
    """One row per input row: doc_id, n_tokens, n_edits, n_tokens_edited, n_leaves, encoded_leaves."""
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("_text"))
    counted = rows.withColumns({"_tree": build_tree(F.col("_text"), ranks), "_edits": digit_masks("_text")})
    after = counted.withColumn("_after", apply_edits(F.col("_text"), F.col("_tree"), F.col("_edits"), ranks))
    return after.select(
        "doc_id", F.get("_tree.tokens", F.lit(1)).alias("n_tokens"), F.size("_edits").cast("bigint").alias("n_edits"),
        F.col("_after.tokens").alias("n_tokens_edited"), F.col("_after.leaves").alias("n_leaves"), F.col("_after.encoded_leaves").alias("encoded_leaves"),
    )
