"""Repeated byte strings by suffix sorting: deep-shallow sorting of the suffixes at chosen places.

Every string of ``length`` bytes (100) has a place of its own that depends on its bytes only: where, of all its grams of
40 bytes, the one with the least hash begins. Equal strings have equal grams at equal distances, and neighbouring
strings mostly share their place, so one place in about thirty bytes stands for all strings: a *unit* is a place with
the strings that have it, ``first`` to ``last``.

1. Units are dealt by their gram. Units that agree in all bytes (by two hashes of 64 bits) are the same; all but the
   earliest are repeats. Most grams are met by one unit only and are done.
2. Other units of a gram share some of their strings. For those, bytes are fetched and two suffix orders are made in
   the gram's task: of the bytes from the place on, and of the bytes before it, read backwards. Suffixes are ordered by
   multikey quicksort down to a shallow depth; those still equal, which share long prefixes, go into a blind trie.
   A string reaching d bytes before its place is equal to another one if they share d bytes backwards and ``length`` - d
   onwards, which the common prefixes of neighbours in both orders tell for all units at once.
3. Repeated strings of a document are merged to spans of bytes, and these are cut out.

Grams met by very many different units (found in a bounded sample of documents, or counted) are not gathered: their
strings are dealt one by one, by their own hashes, with what a task knows to be repeated already left at home.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stratakit.llm.common import stored

LENGTH = 100
PIECE = 1 << 17
SHALLOW = 16
TEXT_AT_ONCE = 8 << 20
"""Bytes of text that a task looks at together."""
TEXT_PER_TASK = 24 << 20
"""Bytes of text whose units make one task of the exchange by grams."""
UNITS_PER_TASK = 100_000
SAMPLE_DOCS, SAMPLE_UNITS = 50_000, 64
"""Grams with so many different units in a sample of so many documents are dealt string by string."""
GROUP_UNITS = 20_000
"""The same is done for grams with more units than this."""
LAST = 2**63 - 1
KEY, REPEAT, ALONE = ["doc", "tie"], 1, 2

_seeds = np.random.default_rng(2024)
_TABLES = _seeds.integers(1, 2**63, (2, 256), dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_BASES = [0x9E3779B97F4A7C15, 0xD6E8FEB86659FD93]


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    out[0] = 1
    return np.cumprod(out)


_UP = [_powers(b, PIECE + 512) for b in _BASES]
_DOWN = [_powers(pow(b, -1, 2**64), PIECE + 512) for b in _BASES]


def _mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(31))) * np.uint64(0x7FB5D329728EA185)
    return h ^ (h >> np.uint64(27))


def gram_length(length: int) -> int:
    """So long that a unit has 61 strings at most."""
    return max(2 * length // 5, length - 60)


# ---- units ---------------------------------------------------------------------------------------


def units(texts: list[bytes], length: int, hot: np.ndarray) -> dict[str, np.ndarray]:
    """The units of some texts: k1 (the gram), k2 (all bytes), which text, place, first and last string, kind.

    Strings of hot grams come as units of one string each, with two hashes of that string. Strings across two texts
    don't count. The order is that of the texts and of the places in them.
    """
    gram = gram_length(length)
    whole = np.frombuffer(b"".join(texts), np.uint8)
    sizes = np.array([len(t) for t in texts], np.int64)
    ends = np.cumsum(sizes)
    starts = ends - sizes
    room = np.zeros(len(whole) + 1, np.int32)  # 1 where a string may start
    long = sizes >= length
    np.add.at(room, starts[long], 1)
    np.add.at(room, ends[long] - length + 1, -1)
    room = np.cumsum(room[:-1], dtype=np.int32) > 0
    found: list[tuple[np.ndarray, ...]] = []
    for begin in range(0, max(len(whole) - length + 1, 0), PIECE):
        end = min(begin + PIECE, len(whole) - length + 1)
        valid = room[begin:end]
        if not valid.any():
            continue
        part = whole[begin : end + length - 1]
        sums = []
        for table, up in zip(_TABLES, _UP):
            sums.append(np.zeros(len(part) + 1, np.uint64))
            np.cumsum(table[part] * up[: len(part)], out=sums[-1][1:])

        def hashed(which: int, at, size):
            return _mixed((sums[which][at + size] - sums[which][at]) * _DOWN[which][at])

        grams = _mixed((sums[0][gram:] - sums[0][:-gram]) * _DOWN[0][: len(part) - gram + 1])
        # The least hash and, of equal ones, the leftmost place: both in one number.
        least = (grams & np.uint64(~((1 << 24) - 1) & (2**64 - 1))) | np.arange(len(grams), dtype=np.uint64)
        wide, held = length - gram + 1, 1
        while 2 * held <= wide:
            least, held = np.minimum(least[:-held], least[held:]), 2 * held
        if held < wide:
            least = np.minimum(least[: len(least) - (wide - held)], least[wide - held :])
        place = (least & np.uint64((1 << 24) - 1)).astype(np.int64)
        new = np.ones(len(place), bool)
        new[1:] = (place[1:] != place[:-1]) | (valid[1:] != valid[:-1])
        first = np.flatnonzero(new)
        last = np.append(first[1:], len(place)) - 1
        first, last = first[valid[first]], last[valid[first]]
        place = place[first]
        k1 = grams[place]
        kind = np.zeros(len(first), np.int64)
        k2 = hashed(1, first, last - first + length) ^ _mixed(((place - first) * 64 + last - first).astype(np.uint64))
        if len(hot):
            spot = np.minimum(np.searchsorted(hot, k1), len(hot) - 1)
            is_hot = hot[spot] == k1
            if is_hot.any():
                counts = np.where(is_hot, last - first + 1, 1)
                index = np.repeat(np.arange(len(first)), counts)
                inner = np.arange(len(index)) - np.repeat(np.cumsum(counts) - counts, counts)
                one = is_hot[index]
                at = first[index] + inner
                k1 = np.where(one, hashed(0, at, length) ^ np.uint64(0xA5A5A5A5A5A5A5A5), k1[index])
                k2 = np.where(one, hashed(1, at, length), k2[index])
                kind = np.where(one, ALONE, 0)
                place = np.where(one, at, place[index])
                first, last = np.where(one, at, first[index]), np.where(one, at, last[index])
        text = np.searchsorted(ends, first + begin, side="right")
        off = begin - starts[text]
        found.append((k1, k2, text, place + off, first + off, last + off, kind))
    names = ("k1", "k2", "text", "place", "first", "last", "kind")
    kinds = (np.uint64, np.uint64, *[np.int64] * 5)
    return {n: np.concatenate([f[i] for f in found]) if found else np.zeros(0, k) for i, (n, k) in enumerate(zip(names, kinds))}


def merged(owner: np.ndarray, first: np.ndarray, last: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Runs of neighbouring or overlapping ranges of one owner."""
    order = np.lexsort((first, owner))
    owner, first, last = owner[order], first[order], last[order]
    if not len(owner):
        return owner, first, last
    # Owners one after another on one line, far enough apart.
    far = int(last.max()) + 3
    base = (np.cumsum(np.append(0, owner[1:] != owner[:-1]))) * far
    reach = np.maximum.accumulate(base + last)
    new = np.append(True, base[1:] + first[1:] > reach[:-1] + 1)
    at = np.flatnonzero(new)
    return owner[at], first[at], (reach - base)[np.append(at[1:], len(owner)) - 1]


def _local(found: dict[str, np.ndarray], doc: np.ndarray, tie: np.ndarray) -> pd.DataFrame:
    """Rows for the exchange: the first of equal units, and the runs of the others, which need no further look."""
    k1, k2 = found["k1"], found["k2"]
    order = np.argsort(k1 ^ (k2 * np.uint64(3)), kind="stable")
    repeats = np.zeros(len(order), bool)
    repeats[order[1:]] = (k1[order[1:]] == k1[order[:-1]]) & (k2[order[1:]] == k2[order[:-1]])
    keep = ~repeats
    text, first, last = merged(found["text"][repeats], found["first"][repeats], found["last"][repeats])
    dealt = _mixed(_mixed(doc[text].astype(np.uint64) ^ tie[text].astype(np.uint64)) + first.astype(np.uint64))
    ahead = np.concatenate([found["place"][keep] - found["first"][keep], np.zeros(len(text), np.int64)])
    owner = np.concatenate([found["text"][keep], text])
    return pd.DataFrame(
        {
            "k1": np.concatenate([k1[keep], dealt]).view(np.int64), "k2": np.concatenate([k2[keep], np.zeros(len(text), np.uint64)]).view(np.int64),
            "doc": doc[owner], "tie": tie[owner], "first": np.concatenate([found["first"][keep], first]),
            "more": np.concatenate([found["last"][keep] - found["first"][keep], last - first]),
            "facts": (ahead * 4 + np.concatenate([found["kind"][keep], np.full(len(text), REPEAT)])).astype(np.int32),
        }
    )


DEALT = "k1 long, k2 long, doc long, tie long, first long, more long, facts int"


def _batches(batch: pd.DataFrame) -> Iterator[tuple[list[bytes], np.ndarray, np.ndarray]]:
    """Texts in the order of their documents, as many as may be looked at together."""
    batch = batch.sort_values(KEY, kind="stable")
    texts, doc, tie = [t.encode() for t in batch["text"]], batch["doc"].to_numpy(np.int64), batch["tie"].to_numpy(np.int64)
    begin, held = 0, 0
    for i, t in enumerate(texts):
        held += len(t)
        if held >= TEXT_AT_ONCE or i + 1 == len(texts):
            yield texts[begin : i + 1], doc[begin : i + 1], tie[begin : i + 1]
            begin, held = i + 1, 0


# ---- deep-shallow sorting ------------------------------------------------------------------------


def common_prefix(a: bytes, b: bytes) -> int:
    m = min(len(a), len(b))
    differing = int.from_bytes(a[:m]) ^ int.from_bytes(b[:m])
    return m - (differing.bit_length() + 7) // 8


def _shallow(words: np.ndarray) -> list[np.ndarray]:
    """Multikey quicksort by columns of words, whose rows are compared from the left: groups of equal rows, in order."""
    done, todo = [], [(np.arange(len(words)), 0)] if len(words) else []
    while todo:
        rows, depth = todo.pop()
        if depth == words.shape[1] or len(rows) == 1:
            done.append(rows)
            continue
        keys = words[rows, depth]
        pivot = np.partition(keys, len(keys) // 2)[len(keys) // 2]
        # The smallest part is taken up next, so groups are met in their order.
        for part, further in ((keys > pivot, 0), (keys == pivot, 1), (keys < pivot, 0)):
            if part.any():
                todo.append((rows[part], depth + further))
    return done


def _blind(strings: list[bytes], rows: np.ndarray, order: list[int], shared: list[int]) -> None:
    """Blind trie of one group: appends its rows in order, each with the prefix it shares with the row before.

    Nodes know how deep they branch and the byte that each child begins with (-1: the string ends). A new string goes
    down without looking at the bytes between, is compared with the one string it gets to, and is put in where they differ.
    """
    root: list = [int(rows[0])]  # a leaf lists its equal strings; a node is (depth, children)
    for row in rows[1:].tolist():
        own = strings[row]
        path, node = [], root
        while isinstance(node, tuple):
            path.append(node)
            depth, kids = node
            node = kids.get(own[depth] if depth < len(own) else -1) or next(iter(kids.values()))
        other = strings[node[0]]
        if own == other:
            node.append(row)
            continue
        same = common_prefix(own, other)
        mine, its = own[same] if same < len(own) else -1, other[same] if same < len(other) else -1
        above = [n for n in path if n[0] <= same]
        if above and above[-1][0] == same:
            above[-1][1][mine] = [row]
            continue
        below = path[len(above)] if len(above) < len(path) else node
        joined = (same, {its: below, mine: [row]})
        if above:
            depth, kids = above[-1]
            kids[other[depth] if depth < len(other) else -1] = joined
        else:
            root = joined
    todo: list = [(root, 0)]
    while todo:
        node, prefix = todo.pop()
        if isinstance(node, tuple):
            depth, kids = node
            inner = sorted(kids)
            todo += [(kids[c], depth) for c in reversed(inner[1:])] + [(kids[inner[0]], prefix)]
        else:
            order += node
            shared += [prefix] + [len(strings[node[0]])] * (len(node) - 1)


def deep_shallow(strings: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """The order of the strings, and how many bytes each shares with the one before it in that order."""
    heads = np.frombuffer(b"".join(s[:SHALLOW].ljust(SHALLOW, b"\0") for s in strings), ">u8").astype(np.uint64).reshape(len(strings), -1)
    order: list[int] = []
    shared: list[int] = []
    for rows in _shallow(heads):
        at = len(order)
        _blind(strings, rows, order, shared)
        shared[at] = common_prefix(strings[order[at - 1]], strings[order[at]]) if at else 0
    return np.array(order, np.int64), np.array(shared, np.int64)


def repeated_strings(before: list[bytes], onwards: list[bytes], length: int) -> np.ndarray:
    """(units, distances): whether the string that far before the place is one of an earlier unit.

    ``before`` is read backwards from the place. Units come in order of their documents and places.
    """
    n, gram = len(before), gram_length(length)
    right, right_shared = deep_shallow(onwards)
    left, left_shared = deep_shallow(before)
    back, ahead = np.array([len(s) for s in before]), np.array([len(s) for s in onwards])
    found = np.zeros((n, length - gram + 1), bool)
    group = np.zeros((2, n), np.int64)
    for d in range(length - gram + 1):
        group[0, right] = np.cumsum(right_shared < length - d)
        group[1, left] = np.cumsum(left_shared < d) if d else 0
        use = np.flatnonzero((back >= d) & (ahead >= length - d))
        if len(use) > 1:
            _, firsts = np.unique(group[0, use] * (n + 1) + group[1, use], return_index=True)
            found[use, d] = True
            found[use[firsts], d] = False
    return found


# ---- the job -------------------------------------------------------------------------------------


def _rows(df: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(nameless, doc, text, tie, copies): doc and tie tell rows apart and give their order; equal rows are one."""
    own = F.col(f"`{id_col}`").cast("long")
    rows = df.select(
        own.isNull().alias("nameless"), F.coalesce(own, F.lit(LAST)).alias("doc"),
        F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit("")).alias("text"),
    )
    if rows.groupBy("doc").count().where("count > 1").isEmpty():
        return rows.withColumns({"tie": F.lit(0).cast("long"), "copies": F.lit(1).cast("long")})
    rows = rows.withColumn("tie", F.xxhash64("text", "nameless"))
    once = rows.groupBy("doc", "tie").agg(
        F.first("nameless").alias("nameless"), F.first("text").alias("text"), F.count(F.lit(1)).alias("copies")
    )
    return stored(once)


def _units_of(rows: DataFrame, length: int, hot: np.ndarray) -> DataFrame:
    def find(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for texts, doc, tie in _batches(batch):
                yield _local(units(texts, length, hot), doc, tie)

    return rows.select("doc", "tie", "text").mapInPandas(find, DEALT)


def _resolved(dealt: DataFrame, tasks: int) -> DataFrame:
    """(doc, tie, first, more, gram, ahead, open): runs of repeated strings, and the units that are still open.

    Of equal units the earliest stays; it is open if other units of its gram differ from it.
    """

    def resolve(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        parts = list(batches)
        if not parts:
            return
        all_rows = pd.concat(parts, ignore_index=True)
        del parts
        c = {name: all_rows[name].to_numpy() for name in all_rows.columns}
        del all_rows
        kind = c["facts"] & 3
        known = kind == REPEAT
        order = np.lexsort((c["first"], c["tie"], c["doc"], c["k2"], c["k1"], known))
        order = order[: len(order) - int(known.sum())]
        k1, k2 = c["k1"][order], c["k2"][order]
        other_gram = np.append(True, k1[1:] != k1[:-1])[: len(k1)]
        new = (other_gram | np.append(True, k2[1:] != k2[:-1])[: len(k2)]) if len(k1) else other_gram
        gram = np.cumsum(other_gram) - 1
        several = np.bincount(gram[new], minlength=gram[-1] + 1 if len(gram) else 0) > 1
        need = order[new & several[gram] & (kind[order] == 0)] if len(gram) else order
        gone = np.concatenate([order[~new], np.flatnonzero(known)])
        at = np.concatenate([gone, need])
        yield pd.DataFrame(
            {
                "doc": c["doc"][at], "tie": c["tie"][at], "first": c["first"][at], "more": c["more"][at], "gram": c["k1"][at],
                "ahead": (c["facts"][at] >> 2).astype(np.int32), "open": np.arange(len(at)) >= len(gone),
            }
        )

    schema = "doc long, tie long, first long, more long, gram long, ahead int, open boolean"
    return dealt.repartition(tasks, "k1").mapInPandas(resolve, schema)


def _packed(rows: DataFrame) -> DataFrame:
    """Texts compressed for the exchange."""

    def pack(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        squeeze = zstandard.ZstdCompressor(level=1).compress
        for batch in batches:
            batch["text"] = [squeeze(t.encode()) for t in batch["text"]]
            yield batch

    kinds = {"text": "binary", "doc": "long", "tie": "long", "copies": "long", "nameless": "boolean"}
    return rows.mapInPandas(pack, ", ".join(f"{c} {kinds[c]}" for c in rows.columns))


def _with_bytes(rows: DataFrame, need: DataFrame, length: int) -> DataFrame:
    """The units with the bytes before their place, backwards, and from it on."""
    listed = need.groupBy(*KEY).agg(F.collect_list(F.struct("first", "more", "ahead", "gram")).alias("units"))

    def fetch(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        open_up = zstandard.ZstdDecompressor().decompress
        for batch in batches:
            out = []
            for doc, tie, text, own in zip(batch["doc"], batch["tie"], batch["text"], batch["units"]):
                body = open_up(text)
                for u in own:
                    first, place, end = u["first"], u["first"] + u["ahead"], u["first"] + u["more"] + length
                    out.append((u["gram"], doc, tie, first, u["more"], u["ahead"], body[first:place][::-1], body[place:end]))
            yield pd.DataFrame(out, columns=["gram", "doc", "tie", "first", "more", "ahead", "before", "onwards"])

    met = _packed(rows.select("doc", "tie", "text")).join(listed, KEY)
    return met.mapInPandas(fetch, "gram long, doc long, tie long, first long, more long, ahead int, before binary, onwards binary")


def _sorted_units(near: DataFrame, tasks: int, length: int) -> DataFrame:
    """(doc, tie, first, more): the runs of strings that an earlier unit of the same gram has."""

    def find(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        parts = list(batches)
        if not parts:
            return
        rows = pd.concat(parts, ignore_index=True).sort_values([*KEY, "first"], kind="stable", ignore_index=True)
        found = repeated_strings(rows["before"].tolist(), rows["onwards"].tolist(), length)
        place = rows["first"].to_numpy() + rows["ahead"].to_numpy()
        unit, distance = np.nonzero(found)
        owner, first, last = merged(unit, place[unit] - distance, place[unit] - distance)
        yield pd.DataFrame({"doc": rows["doc"].to_numpy()[owner], "tie": rows["tie"].to_numpy()[owner], "first": first, "more": last - first})

    return near.repartition(tasks, "gram").mapInPandas(find, "doc long, tie long, first long, more long")


def _string_by_string(near: DataFrame, length: int) -> DataFrame:
    """The strings of fetched units, each as a unit of its own, dealt like those of hot grams."""

    def spell(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            batch = batch.sort_values([*KEY, "first"], kind="stable", ignore_index=True)
            texts = [b[::-1] + o for b, o in zip(batch["before"], batch["onwards"])]
            found = units(texts, length, np.array([], np.uint64))
            every = units(texts, length, np.unique(found["k1"]))
            off = batch["first"].to_numpy()[every["text"]]
            for name in ("place", "first", "last"):
                every[name] = every[name] + off
            yield _local(every, batch["doc"].to_numpy(np.int64), batch["tie"].to_numpy(np.int64))

    return near.mapInPandas(spell, DEALT)


def _hot_grams(rows: DataFrame, total: int, length: int, sample_docs: int, sample_units: int) -> np.ndarray:
    """Grams that many different units of the sampled documents have: no more than the sample can hold."""
    share = min(1.0, sample_docs / max(total, 1))
    drawn = rows.where(F.pmod(F.xxhash64(F.lit(5), *[F.col(k) for k in KEY]), F.lit(1 << 30)) < int(share * (1 << 30)))
    found = _units_of(drawn, length, np.array([], np.uint64)).where(f"(facts & 3) <> {REPEAT}")
    many = found.groupBy("k1").agg(F.count(F.lit(1)).alias("n"))
    grams = many.where(F.col("n") >= sample_units).select("k1").toPandas()["k1"].to_numpy(np.int64)
    return np.sort(grams.view(np.uint64))


def remove_repeats(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = LENGTH, with_text: bool = True,
                   sample_docs: int = SAMPLE_DOCS, sample_units: int = SAMPLE_UNITS, group_units: int = GROUP_UNITS) -> DataFrame:
    """(doc_id, n_bytes, n_removed, n_spans, kept_sha256[, kept, spans]) of each row.

    A text is its UTF-8 bytes. A byte goes if a string of ``length`` bytes over it also starts earlier: in a document with
    a smaller id, or before it in the same one. All strings are judged on the input. ``kept`` is the rest, which may cut
    a character apart, and ``spans`` the removed runs as (start, end).

    A null text is empty; texts shorter than ``length`` stay whole. Rows without an id come last. Of rows with one id
    the order is that of a hash of their texts, and of equal rows all but one lose whatever is long enough to go.
    An empty table gives no rows; other columns are left aside.
    """
    if not 16 <= length <= 400:
        raise ValueError("length must be from 16 to 400 bytes")
    rows = _rows(df, id_col, text_col)
    total, size = rows.agg(F.count(F.lit(1)), F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).head()
    width = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    tasks = max(1, min(width, 1 + size // 1_000_000), -(-size // TEXT_PER_TASK))
    hot = _hot_grams(rows, total, length, sample_docs, sample_units)
    found = stored(_resolved(_units_of(rows, length, hot), tasks))
    need = found.where("open")
    sizes = need.groupBy("gram").agg(F.count(F.lit(1)).alias("n"))
    asking, most = sizes.agg(F.coalesce(F.sum("n"), F.lit(0)), F.coalesce(F.max("n"), F.lit(0))).head()
    runs = [found.where("not open").select(*KEY, "first", "more")]
    if asking:
        near = stored(_with_bytes(rows, need, length))
        if most > group_units:
            crowded = stored(sizes.where(F.col("n") > group_units).select("gram"))
            spelt = _resolved(_string_by_string(near.join(crowded, "gram", "left_semi"), length), tasks)
            runs.append(stored(spelt.where("not open").select(*KEY, "first", "more")))
            near = near.join(crowded, "gram", "left_anti")
        runs.append(stored(_sorted_units(near, max(1, min(tasks, 1 + asking // 2000), -(-asking // UNITS_PER_TASK)), length)))
    every = runs[0]
    for more in runs[1:]:
        every = every.unionAll(more)
    listed = every.groupBy(*KEY).agg(F.collect_list(F.struct("first", "more")).alias("runs"))

    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        open_up = zstandard.ZstdDecompressor().decompress
        for batch in batches:
            out = []
            for doc, nameless, text, copies, own in zip(*[batch[c] for c in ("doc", "nameless", "text", "copies", "runs")]):
                body = open_up(text)
                spans = []
                if own is not None and len(own):
                    first = np.array([r["first"] for r in own], np.int64)
                    end = first + np.array([r["more"] for r in own], np.int64) + length
                    _, first, last = merged(np.zeros(len(first), np.int64), first, end - 1)
                    spans = list(zip(first.tolist(), (last + 1).tolist()))
                every_span = [(0, len(body))] if len(body) >= length else []
                for i in range(copies):
                    gone, kept, at = spans if not i else every_span, [], 0
                    for a, b in gone:
                        kept.append(body[at:a])
                        at = b
                    rest = b"".join([*kept, body[at:]])
                    line = (doc, nameless, len(body), len(body) - len(rest), len(gone), hashlib.sha256(rest).hexdigest())
                    out.append((*line, rest, [{"start": a, "end": b} for a, b in gone]) if with_text else line)
            yield pd.DataFrame(out, columns=names)

    names = ["doc", "nameless", "n_bytes", "n_removed", "n_spans", "kept_sha256", *["kept", "spans"] * with_text]
    schema = "doc long, nameless boolean, n_bytes long, n_removed long, n_spans long, kept_sha256 string"
    schema += ", kept binary, spans array<struct<start:long,end:long>>" * with_text
    joined = _packed(rows.select("nameless", "doc", "text", "tie", "copies")).join(listed, KEY, "left")
    result = joined.select("doc", "nameless", "text", "copies", "runs").mapInPandas(cut, schema)
    return result.select(F.when(~F.col("nameless"), F.col("doc")).alias("doc_id"), *names[2:])
