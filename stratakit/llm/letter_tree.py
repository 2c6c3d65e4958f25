"""Spelling variants by k-d trees over letter counts.

A word is a point whose coordinates say how often each letter stands in it. Replacing a letter takes one step up in one
coordinate and one step down in another; an inserted letter is one step up. So words one edit apart have points at
most two apart in L1, and a range search finds them: a k-d tree for each length is asked by the words of that length
(one step up and one down) and by those one letter shorter (one step up). A subtree is entered only if its box can be
reached with the steps that are left. Points that match are then compared letter by letter.

Words are dealt by the upper levels of their length's tree, made from a bounded sample; a word visits every cell whose
box it can reach. In its task a cell continues the tree over all of its words.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import Any

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stratakit.llm.common import stored

LETTERS = "A-Za-z\\u00C0-\\u00FF"
CELL_WORDS, CELL_LETTERS, LEAF_WORDS = 16384, 1 << 22, 48
SAMPLE_PER_CELL, SAMPLE_WORDS = 64, 200_000
COMPARED = 1 << 22
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


# ---- words ---------------------------------------------------------------------------------------


def counted_words(df: DataFrame, id_col: str, text_col: str, least_letters: int, least_count: int, drop_each: int) -> DataFrame:
    """(word, n): the runs of letters, one letter left out of some by a hash, that are long and frequent enough."""
    runs = F.regexp_extract_all(F.col(f"`{text_col}`"), F.lit(f"([{LETTERS}]{{{least_letters},}})"), F.lit(1))
    name = F.coalesce(F.col(f"`{id_col}`").cast("string"), F.lit(""))
    found = df.select(name.alias("name"), F.explode(runs).alias("run"))
    found = found.select("name", F.translate("run", UPPER, LOWER).alias("run"))
    if drop_each:
        found = found.withColumn("h", F.crc32(F.concat("name", F.lit(":"), "run")))
        at = (F.col("h") % F.char_length("run")).cast("int")
        less = F.concat(F.expr("substring(run, 1, at)"), F.expr("substring(run, at + 2)"))
        found = found.withColumn("at", at).select(F.when(F.col("h") % drop_each == 0, less).otherwise(F.col("run")).alias("run"))
        found = found.where(F.char_length("run") >= least_letters)
    counts = found.groupBy(F.col("run").alias("word")).agg(F.count(F.lit(1)).alias("n"))
    return counts.where(F.col("n") >= least_count)


# ---- trees ---------------------------------------------------------------------------------------


def letter_matrix(words: list[str]) -> np.ndarray:
    """Words of one length as rows of bytes; every letter of the alphabet is one byte in Latin-1."""
    length = len(words[0]) if words else 0
    return np.frombuffer("".join(words).encode("latin-1"), np.uint8).reshape(len(words), length)


def letter_counts(letters: np.ndarray) -> np.ndarray:
    """How often each byte stands in each row: (rows, 256)."""
    n = len(letters)
    at = (np.arange(n)[:, None] * 256 + letters).ravel()
    return np.bincount(at, minlength=n * 256).reshape(n, 256).astype(np.int32)


def split(points: np.ndarray, most: int, rows: np.ndarray | None = None) -> Any:
    """A tree: ``(letter, least, below, from)`` or, as a leaf, the places of its points.

    Each node is cut at the letter and count that part its points most evenly. Equal points stay together.
    """
    rows = np.arange(len(points)) if rows is None else rows
    if len(rows) <= most:
        return rows
    own = points[rows]
    best = (0, 0, 0)
    for value in np.flatnonzero(np.bincount(own.ravel()))[1:].tolist():
        above = (own >= value).sum(0)
        even = np.minimum(above, len(rows) - above)
        letter = int(even.argmax())
        best = max(best, (int(even[letter]), letter, value))
    if not best[0]:
        return rows
    _, letter, least = best
    low = own[:, letter] < least
    return letter, least, split(points, most, rows[low]), split(points, most, rows[~low])


def numbered(tree: Any, counter: list[int]) -> Any:
    """The tree with numbers in place of its leaves' points."""
    if isinstance(tree, tuple):
        return tree[0], tree[1], numbered(tree[2], counter), numbered(tree[3], counter)
    counter[0] += 1
    return counter[0] - 1


def homes(tree: Any, points: np.ndarray) -> np.ndarray:
    """The leaf that each point lies in."""
    found = np.zeros(len(points), np.int32)
    todo = [(tree, np.arange(len(points)))]
    while todo:
        node, rows = todo.pop()
        if isinstance(node, tuple):
            low = points[rows, node[0]] < node[1]
            todo += [(node[2], rows[low]), (node[3], rows[~low])]
        else:
            found[rows] = node
    return found


def reached(tree: Any, points: np.ndarray, ups: int, downs: int) -> Iterator[tuple[Any, np.ndarray]]:
    """Leaves with the points that can get into the leaf's box by so many steps up and down, over all letters."""
    n = len(points)
    todo = [(tree, np.arange(n), np.full(n, ups), np.full(n, downs), {})]
    while todo:
        node, rows, up, down, box = todo.pop()
        if not len(rows):
            continue
        if not isinstance(node, tuple):
            yield node, rows
            continue
        letter, least, below, above = node
        own = points[rows, letter]
        low, high = box.get(letter, (0, np.iinfo(np.int32).max))
        # Steps that this cut asks for beyond those that earlier cuts at the same letter have asked for.
        more_down = np.maximum(own - (least - 1), 0) - np.maximum(own - high, 0)
        more_up = np.maximum(least - own, 0) - np.maximum(low - own, 0)
        can = more_down <= down
        todo.append((below, rows[can], up[can], (down - more_down)[can], box | {letter: (low, least - 1)}))
        can = more_up <= up
        todo.append((above, rows[can], (up - more_up)[can], down[can], box | {letter: (least, high)}))


# ---- one edit ------------------------------------------------------------------------------------


def one_edit(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Row by row: whether b is a with exactly one letter replaced or, if longer by one, inserted."""
    if a.shape[1] == b.shape[1]:
        return (a != b).sum(1) == 1
    ahead = (a == b[:, :-1]).cumprod(1).sum(1, dtype=np.int64)
    behind = (a == b[:, 1:])[:, ::-1].cumprod(1).sum(1, dtype=np.int64)
    return ahead + behind >= a.shape[1]


def near_pairs(words: list[str], asking: list[str]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Places (asking, words) of all pairs one edit apart; the words have one length, the asking that or one less."""
    if not words or not asking:
        return
    members, visitors = letter_matrix(words), letter_matrix(asking)
    longer = members.shape[1] - visitors.shape[1]
    points, asked = letter_counts(members), letter_counts(visitors)
    used = np.flatnonzero((points.max(0) > 0) | (asked.max(0) > 0))
    small = np.uint8 if members.shape[1] < 256 else np.int32
    points, asked = np.ascontiguousarray(points[:, used]), np.ascontiguousarray(asked[:, used])
    narrow, narrow_asked = points.astype(small), asked.astype(small)
    wanted = members.shape[1] - 1  # letters in common, either way
    for own, rows in reached(split(points, LEAF_WORDS), asked, 1, 1 - longer):
        at_once = max(1, COMPARED // (8 * len(own)))
        theirs = narrow[own]
        for i in range(0, len(rows), at_once):
            part = rows[i : i + at_once]
            mine = narrow_asked[part]
            common = np.zeros((len(part), len(own)), small)
            for letter in np.flatnonzero(theirs.any(0) & mine.any(0)):
                common += np.minimum(mine[:, letter, None], theirs[None, :, letter])
            x, y = np.nonzero(common == wanted)
            x, y = part[x], own[y]
            together = max(1, COMPARED // members.shape[1])
            for j in range(0, len(x), together):
                p, q = x[j : j + together], y[j : j + together]
                good = one_edit(visitors[p], members[q])
                yield p[good], q[good]


# ---- the job -------------------------------------------------------------------------------------


def _cells(words: DataFrame, cell_words: int) -> dict[int, Any]:
    """The upper tree of each length that needs more than one cell, from a bounded sample of its words."""
    sizes = words.groupBy(F.char_length("word").alias("length")).agg(F.count(F.lit(1)).alias("n"))
    room = F.greatest(F.lit(1), F.least(F.lit(cell_words), F.floor(F.lit(CELL_LETTERS) / F.col("length"))))
    crowded = sizes.withColumn("cells", F.ceil(F.col("n") / room).cast("int")).where("cells > 1").collect()
    asked = sum(r["cells"] for r in crowded) * SAMPLE_PER_CELL
    trees = {}
    for r in crowded:
        size = max(2, min(asked, SAMPLE_WORDS) * r["cells"] * SAMPLE_PER_CELL // asked)
        chance = F.pmod(F.xxhash64(F.lit(7), F.col("word")), F.lit(1 << 30)) < int(min(1.0, size / r["n"]) * (1 << 30))
        drawn = words.where((F.char_length("word") == r["length"]) & chance).select("word").toPandas()["word"].tolist()
        if drawn:
            points = letter_counts(letter_matrix(drawn))
            trees[r["length"]] = numbered(split(points, max(1, -(-len(drawn) // r["cells"]))), [0])
    return trees


def near_words(words: DataFrame, cell_words: int = CELL_WORDS) -> DataFrame:
    """(word, n, other, other_n): both ways, every pair of the distinct words (word, n) that is one edit apart."""
    trees = _cells(words, cell_words)

    def place(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            batch = batch.astype({"word": object})
            for length, own in batch.groupby(batch["word"].str.len()):
                points = letter_counts(letter_matrix(own["word"].tolist()))
                tree = trees.get(length, 0)
                yield own.assign(length=length, cell=homes(tree, points), asks=False)
                for target, downs in ((length, 1), (length + 1, 0)):
                    for cell, rows in reached(trees.get(target, 0), points, 1, downs):
                        yield own.iloc[rows].assign(length=target, cell=cell, asks=True)

    def search(rows: pd.DataFrame, asking: pd.DataFrame) -> pd.DataFrame:
        names, counts, out = rows["word"].to_numpy(object), rows["n"].to_numpy(), []
        for _, own in asking.groupby(asking["word"].str.len()):
            asked, own_counts = own["word"].to_numpy(object), own["n"].to_numpy()
            for p, q in near_pairs(names.tolist(), asked.tolist()):
                # Words of one length ask for each other, so each such pair is met twice.
                once = np.array([len(a) < len(b) or a < b for a, b in zip(asked[p], names[q])], bool)
                p, q = p[once], q[once]
                out.append((asked[p], own_counts[p], names[q], counts[q]))
        columns = [np.concatenate(c) for c in zip(*out)] if out else [[], [], [], []]
        return pd.DataFrame({c: pd.Series(x, dtype=kind) for c, x, kind in zip(pair, columns, (object, "int64") * 2)})

    pair = ("word", "n", "other", "other_n")
    placed = stored(words.select("word", "n").mapInPandas(place, "word string, n long, length int, cell int, asks boolean"))
    there, here = placed.where("not asks").drop("asks"), placed.where("asks").drop("asks")
    here = here.toDF(*here.columns)
    found = stored(
        there.groupBy("length", "cell").cogroup(here.groupBy("length", "cell")).applyInPandas(
            search, "word string, n long, other string, other_n long"
        )
    )
    back = found.select(F.col("other").alias("word"), F.col("other_n").alias("n"), F.col("word").alias("other"), F.col("n").alias("other_n"))
    return found.union(back)


def follow(forms: DataFrame) -> DataFrame:
    """(word, root): where each word gets by going from form to form. Every round doubles the steps."""
    roots = stored(forms.select("word", F.col("form").alias("root")))
    while True:
        further = roots.select(F.col("word").alias("root"), F.col("root").alias("further"))
        moved = stored(roots.join(further, "root", "left").select("word", "root", "further"))
        if moved.where("further is not null").isEmpty():
            return roots
        roots = moved.select("word", F.coalesce("further", "root").alias("root"))


def variants(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", least_letters: int = 7, least_count: int = 2,
             ratio: int = 10, drop_each: int = 0, cell_words: int = CELL_WORDS) -> DataFrame:
    """(word, form, root, n, n_near, form_n) of each word with enough letters and occurrences.

    Words are maximal runs of Latin letters up to U+00FF, with A to Z in lower case. Words are near if one
    inserted, deleted or replaced letter makes one of the other. A word's form is its near word of largest n, of these
    the first by code points, if that n is at least ``ratio`` times its own; its root is where forms lead, the word
    itself if it has none. With ``drop_each`` a run in a document loses one letter where the CRC-32 of ``<id>:<run>``
    is divisible by it, which makes misspellings to test with.

    Null and empty texts have no words, and a null id is an empty text in the hash. Repeated rows count again. A word
    may be as long as a text. An empty table gives no rows.
    """
    if ratio < 2:
        raise ValueError("forms must be more frequent than their words, or they could lead in circles")
    words = stored(counted_words(df, id_col, text_col, least_letters, least_count, drop_each))
    near = near_words(words, cell_words).groupBy("word").agg(
        F.count(F.lit(1)).alias("n_near"), F.min(F.struct((-F.col("other_n")).alias("less"), "other")).alias("best")
    )
    named = stored(
        words.join(near, "word", "left").withColumn("takes", F.coalesce(-F.col("best.less") >= F.lit(ratio) * F.col("n"), F.lit(False)))
        .select(
            "word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
            F.when(F.col("takes"), F.col("best.other")).alias("form"), F.when(F.col("takes"), -F.col("best.less")).alias("form_n"),
        )
    )
    roots = follow(named.where("form is not null"))
    return named.join(roots, "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n"
    )
