"""Spelling variants: words one edit apart, found by products of letter counts.

The vocabulary is counted once. Words lie in cells by how many letters of each
letter class they have; a cell therefore holds words of one length. One edit
moves a word at most to a cell of the same length (one class up, one down) or of
the next length (one class up), so only such pairs of cells are compared. Cells
are cut into blocks, and for a pair of blocks one NumPy product of the letter
counts gives the squared distances of all their words. A replaced letter changes
two counts by one, an inserted or deleted letter one count, so pairs at a squared
distance of at most two are kept and verified letter by letter.

Every pair of blocks is one row, which any task can work on: no cell, however
large, meets in one task as a whole.
"""

from __future__ import annotations

import math
import re
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from subtide.llm.frames import bytes_of, map_pieces, prepare_workers
from subtide.session import materialized

#: Fixed value: the letters of a word, after A-Z are lower-cased.
LETTERS = "a-zÀ-ÿ"
_LOWER = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz")

#: Distinct words that a task counts before it hands them on.
COUNTED = 200_000

#: Words and letters of a block at most (one word may be longer), and products that a task holds at once.
BLOCK_WORDS, BLOCK_LETTERS, TILE = 2048, 1 << 18, 1 << 22

#: Compared pairs of words in a partition, about.
PARTITION_PAIRS = 1 << 29

WORD = T.StructType([T.StructField("word", T.StringType(), False), T.StructField("n", T.LongType(), False)])
NEAR = T.StructType(
    [T.StructField("word", T.StringType(), False), T.StructField("near", T.StringType(), False), T.StructField("near_n", T.LongType(), False)]
)


# --- vocabulary --------------------------------------------------------------


def vocabulary(
    docs: DataFrame,
    least_letters: int = 7,
    least_count: int = 2,
    misspell_every: int | None = None,
    text_column: str = "text",
    id_column: str = "doc_id",
) -> DataFrame:
    """``word, n``: the words of whole texts and how often they occur.

    Words are maximal runs of Latin letters with A-Z lower-cased. With
    ``misspell_every`` the runs whose crc32 of ``<id>:<run>`` it divides lose one
    letter first, a test of the grouping on planted errors. Null texts have no
    words, a null id is the empty text, repeated rows count again.
    """
    runs = re.compile(f"[{LETTERS}]{{{least_letters},}}")

    def start():
        counts: Counter[str] = Counter()

        def flush() -> Iterator[pa.RecordBatch]:
            words, numbers = list(counts.keys()), list(counts.values())
            counts.clear()
            for at in range(0, len(words), 10_000):
                part = slice(at, at + 10_000)
                yield pa.RecordBatch.from_arrays([pa.array(words[part], pa.string()), pa.array(numbers[part], pa.int64())], WORD.names)

        def step(batch):
            if batch is None:
                yield from flush()
                return
            names = batch.column("id").to_pylist()
            for name, text in zip(names, bytes_of(batch, "text")):
                own = Counter(runs.findall(text.translate(_LOWER).decode()))
                if misspell_every:
                    own = _misspelt(own, name or "", misspell_every, least_letters)
                for word, n in own.items():
                    counts[word] += n
                if len(counts) > COUNTED:
                    yield from flush()

        return step

    rows = docs.select(F.col(id_column).cast("string").alias("id"), F.col(text_column).alias("text"))
    counted = map_pieces(rows, "text", WORD, start)
    return counted.groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= least_count)


def _misspelt(own: Counter[str], name: str, every: int, least_letters: int) -> Counter[str]:
    """Words of one text, some with one letter less."""
    out: Counter[str] = Counter()
    prefix = zlib.crc32(f"{name}:".encode())
    for word, n in own.items():
        code = zlib.crc32(word.encode(), prefix)
        if code % every == 0:
            at = code % len(word)
            word = word[:at] + word[at + 1 :]
        if len(word) >= least_letters:
            out[word] += n
    return out


# --- products of letter counts -----------------------------------------------


def _spelt(words: list[str]) -> np.ndarray:
    """Letters of words of one length, one row each; every letter is one byte."""
    return np.frombuffer("".join(words).encode("latin-1"), np.uint8).reshape(len(words), -1)


def _counts(letters: np.ndarray, place: np.ndarray, kinds: int) -> np.ndarray:
    rows = np.arange(len(letters))[:, None] * kinds
    return np.bincount((rows + place[letters]).ravel(), minlength=len(letters) * kinds).reshape(len(letters), kinds)


def near_pairs(left: list[str], right: list[str], same: bool) -> tuple[np.ndarray, np.ndarray]:
    """Places of the words one edit apart in two blocks.

    Words of a block have one length; those of ``right`` are as long or one
    letter longer. With ``same`` both blocks are one, and each pair counts once.
    """
    a, b = _spelt(left), _spelt(right)
    used = np.unique(np.concatenate([np.unique(a), np.unique(b)]))
    place = np.zeros(256, np.int64)
    place[used] = np.arange(len(used))
    # Products of counts must be exact: float32 holds whole numbers up to 2^24.
    kind = np.float32 if b.shape[1] < 2000 else np.float64
    x, y = (_counts(letters, place, len(used)).astype(kind) for letters in (a, b))
    half_x, half_y = ((m * m).sum(axis=1, keepdims=True) / 2 for m in (x, y))
    # One product gives x.y - (x.x + y.y) / 2, which is minus half the squared distance.
    x = np.hstack([x, -half_x, np.ones_like(half_x)])
    y = np.ascontiguousarray(np.hstack([y, np.ones_like(half_y), -half_y]).T)
    found = [(np.empty(0, np.int64), np.empty(0, np.int64))]
    height = max(1, TILE // len(right))
    for first in range(0, len(left), height):
        close = np.flatnonzero((x[first : first + height] @ y).ravel() >= -1)
        i, j = close // len(right) + first, close % len(right)
        if same:
            i, j = i[j > i], j[j > i]
        step = max(1, TILE // b.shape[1])
        for at in range(0, len(i), step):
            p, q = i[at : at + step], j[at : at + step]
            ok = _one_edit(a[p], b[q])
            found.append((p[ok], q[ok]))
    return np.concatenate([p for p, _ in found]), np.concatenate([q for _, q in found])


def _one_edit(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact check of pairs of words: one letter replaced, or one more in ``b``."""
    length = a.shape[1]
    if b.shape[1] == length:
        return (a != b).sum(axis=1) == 1
    alike = np.cumprod(a == b[:, :-1], axis=1, dtype=np.uint8).sum(axis=1, dtype=np.int64)
    alike += np.cumprod((a == b[:, 1:])[:, ::-1], axis=1, dtype=np.uint8).sum(axis=1, dtype=np.int64)
    return alike >= length


def _compared(pairs: DataFrame) -> DataFrame:
    """``word, near, near_n`` in both directions from rows ``same, l, r`` of two blocks each."""
    prepare_workers(pairs.sparkSession)

    def run(batches):
        for batch in batches:
            sides = [batch.column(name) for name in ("l", "r")]
            for row, same in enumerate(batch.column("same").to_pylist()):
                (words, ns), (others, other_ns) = (_block(side, row) for side in sides)
                i, j = near_pairs(words.to_pylist(), others.to_pylist(), same)
                if len(i):
                    i, j = pa.array(i), pa.array(j)
                    for own, near, n in ((words.take(i), others.take(j), other_ns.take(j)), (others.take(j), words.take(i), ns.take(i))):
                        yield pa.RecordBatch.from_arrays([own, near, n], NEAR.names)

    return pairs.mapInArrow(run, NEAR)


def _block(side: pa.ListArray, row: int) -> tuple[pa.Array, pa.Array]:
    block = side[row].values
    return block.field("word"), block.field("n")


# --- cells and blocks --------------------------------------------------------


def letter_classes(words: int) -> int:
    """Letter classes for so many words. More classes make more and smaller cells; the pairs found are the same."""
    return min(16, max(2, round(math.log2(max(words, 1))) - 15))


def _cell(word: Column, classes: int) -> list[Column]:
    """How many letters of each class (code point modulo ``classes``) a word has."""
    letters = [chr(c) for c in [*range(97, 123), *range(0xC0, 0x100)]]
    own = lambda k: "".join(c for c in letters if ord(c) % classes == k)
    return [(F.length(word) - F.length(F.translate(word, own(k), ""))).cast("int") for k in range(classes)]


def _reached(cell: Column, classes: int) -> Column:
    """Cells whose words may be one edit away from words of ``cell``; of two cells only one reaches the other."""
    moved = lambda up, down: F.array(*(cell[k] + (int(k == up) - int(k == down)) for k in range(classes)))
    steps = [moved(None, None), *(moved(k, None) for k in range(classes))]
    return F.array(*steps, *(moved(up, down) for up in range(classes) for down in range(up + 1, classes)))


def near_words(words: DataFrame) -> DataFrame:
    """``word, near, near_n``: all words of ``words`` (``word, n``, words once each) exactly one edit apart, both ways."""
    spark = words.sparkSession
    total = words.count()
    classes = letter_classes(total)
    placed = words.select("word", "n", F.array(*_cell(F.col("word"), classes)).alias("cell"))
    size = F.greatest(F.lit(1), F.least(F.lit(BLOCK_WORDS), F.lit(BLOCK_LETTERS) / F.max(F.length("word"))).cast("int"))
    cells = placed.groupBy("cell").agg(F.count(F.lit(1)).alias("n_words"), size.alias("size"))
    cells = materialized(cells.withColumn("parts", F.ceil(F.col("n_words") / F.col("size")).cast("int")).drop("size"), "cells")
    part = F.pmod(F.xxhash64("word"), F.col("parts")).cast("int")
    blocks = placed.join(cells, "cell").withColumn("part", part).groupBy("cell", "part")
    # A block holds BLOCK_WORDS words on average, dealt out by hash.
    blocks = materialized(blocks.agg(F.collect_list(F.struct("word", "n")).alias("words")), "blocks")

    other = cells.select(F.col("cell").alias("other"), F.col("parts").alias("other_parts"), F.col("n_words").alias("other_words"))
    pairs = cells.select("*", F.explode(_reached(F.col("cell"), classes)).alias("other")).join(other, "other")
    pairs = materialized(pairs, "cell-pairs")
    work = pairs.agg(F.sum(F.col("n_words").cast("double") * F.col("other_words"))).first()[0] or 0
    partitions = max(int(spark.conf.get("spark.sql.shuffle.partitions")), math.ceil(work / PARTITION_PAIRS))

    units = pairs.withColumn("part", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
    units = units.withColumn("other_part", F.explode(F.sequence(F.lit(0), F.col("other_parts") - 1)))
    units = units.where((F.col("cell") != F.col("other")) | (F.col("part") <= F.col("other_part")))
    left = blocks.select("cell", "part", F.col("words").alias("l"))
    right = blocks.select(F.col("cell").alias("other"), F.col("part").alias("other_part"), F.col("words").alias("r"))
    same = (F.col("cell") == F.col("other")) & (F.col("part") == F.col("other_part"))
    # Pairs of blocks are more than their plan's size tells, so they are not to be broadcast.
    joined = units.select("cell", "part", "other", "other_part").hint("merge").join(left, ["cell", "part"])
    # The work of a task is far more than its bytes say, so the number of partitions is given.
    joined = joined.repartition(partitions, "other", "other_part").join(
        right.repartition(partitions, "other", "other_part"), ["other", "other_part"]
    )
    return _compared(joined.select(same.alias("same"), "l", "r"))


# --- forms -------------------------------------------------------------------


def spelling_groups(words: DataFrame, times: int = 10) -> DataFrame:
    """``word, form, root, n, n_near, form_n`` of each word of ``words`` (``word, n``).

    The form of a word is its most frequent near word (of equal ones the smallest)
    if that is at least ``times`` as frequent; the root is where forms lead. A
    word without near words has ``n_near`` 0, its own root and no form. Words
    repeat only if ``words`` repeats them; an empty table gives no rows.
    """
    if times < 2:
        raise ValueError("a form must be more frequent than its word, or forms would lead in circles")
    words = materialized(words, "words")
    best = F.min(F.struct((-F.col("near_n")).alias("less"), "near"))
    near = near_words(words).groupBy("word").agg(F.count(F.lit(1)).alias("n_near"), best.alias("best"))
    joined = words.join(near, "word", "left")
    has_form = -F.col("best.less") >= times * F.col("n")
    found = joined.select(
        "word",
        "n",
        F.coalesce("n_near", F.lit(0)).alias("n_near"),
        F.when(has_form, F.col("best.near")).alias("form"),
        F.when(has_form, -F.col("best.less")).alias("form_n"),
    )
    found = materialized(found, "forms")
    roots = found.where("form IS NOT NULL").select("word", F.col("form").alias("root"))
    most = found.agg(F.max("n")).first()[0] or 1
    # Each form is ``times`` as frequent as its word, so a path has at most this many steps; a join doubles the steps taken.
    steps = math.ceil(math.log(most, times))
    for _ in range(max(0, math.ceil(math.log2(max(steps, 1))))):
        onward = roots.select(F.col("word").alias("root"), F.col("root").alias("next"))
        roots = roots.join(onward, "root", "left").select("word", F.coalesce("next", "root").alias("root"))
        roots = materialized(roots, "roots")
    return found.join(roots, "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n"
    )
