"""Packed token matrices by best-fit-decreasing.

Each task packs the documents of its partition, a window of tokens at a time: pieces by length, longest first, each
into the fullest sequence that still has room. A segment tree over the room left answers that search: its leaves
are the possible rooms, and it finds the smallest one in use that is large enough. Documents longer than a
sequence are cut and nothing is lost. No shuffle is needed, and a lost task packs the same rows again.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stratakit.llm.common import bound_batches
from stratakit.llm.tokens import END, default_path, tokenizer

LENGTH, WINDOW_TOKENS = 2048, 2_000_000


class RoomTree:
    """Which rooms, from 0 to most, some open sequence has. A node tells whether a leaf below it is in use."""

    def __init__(self, most: int):
        self.leaves = 1 << most.bit_length()
        self.used = [0] * (2 * self.leaves)
        self.open: list[list[int]] = [[] for _ in range(most + 1)]

    def add(self, sequence: int, room: int) -> None:
        self.open[room].append(sequence)
        node = self.leaves + room
        while node and len(self.open[room]) == 1:
            self.used[node] += 1
            node >>= 1

    def take(self, least: int) -> tuple[int, int] | None:
        """A sequence with the smallest room that is at least so large, and that room; it is closed."""
        node = self.leaves + least
        if not self.used[node]:
            while node > 1 and (node & 1 or not self.used[node + 1]):
                node >>= 1
            if node <= 1:
                return None
            node += 1
            while node < self.leaves:
                node = 2 * node if self.used[2 * node] else 2 * node + 1
        room = node - self.leaves
        sequence = self.open[room].pop()
        while node and not self.open[room]:
            self.used[node] -= 1
            node >>= 1
        return sequence, room


def best_fit_decreasing(lengths: list[int], most: int) -> list[list[int]]:
    """Sequences, each a list of places in lengths; every length is at most ``most``."""
    sequences: list[list[int]] = []
    tree = RoomTree(most)
    for i in sorted(range(len(lengths)), key=lambda i: (-lengths[i], i)):
        found = tree.take(lengths[i])
        if found is None:
            found = len(sequences), most
            sequences.append([])
        sequence, room = found
        sequences[sequence].append(i)
        tree.add(sequence, room - lengths[i])
    return sequences


def pack(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", path: str | None = None, length: int = LENGTH,
         window_tokens: int = WINDOW_TOKENS, pad: int = 0) -> DataFrame:
    """One row per sequence: the matrix row and what is needed to read it.

    tokens is ``length`` little-endian 32-bit ids, padded at the end; positions the same number of 32-bit positions,
    which begin at 0 again with every segment; n_tokens the ids before the padding; cu_seqlens the segments' ends,
    after a 0; doc_ids and starts say which piece of which document each segment is. A document is its ids and id 1;
    null and empty texts are that id alone, and a null id stays null. Concatenating a document's segments by start
    gives its ids again. Repeated rows are packed like others; an empty table gives no sequence.
    """
    path = path or default_path()
    schema = (
        "n_tokens int, cu_seqlens array<int>, doc_ids array<long>, starts array<long>, tokens binary, positions binary"
    )

    def packed(pieces: list[tuple]) -> pd.DataFrame:
        rows = []
        for own in best_fit_decreasing([len(p[2]) // 4 for p in pieces], length):
            parts = [pieces[i] for i in own]
            sizes = [len(p[2]) // 4 for p in parts]
            used = sum(sizes)
            filled = np.full(length, pad, "<u4")
            filled[:used] = np.frombuffer(b"".join([p[2] for p in parts]), "<u4")
            at = np.zeros(length, "<u4")
            at[:used] = np.concatenate([np.arange(n) for n in sizes])
            ends = np.cumsum([0, *sizes]).tolist()
            rows.append((used, ends, [p[0] for p in parts], [p[1] for p in parts], filled.tobytes(), at.tobytes()))
        return pd.DataFrame(rows, columns=["n_tokens", "cu_seqlens", "doc_ids", "starts", "tokens", "positions"])

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        words, pieces, held = tokenizer(path), [], 0
        for batch in batches:
            found = words.encode_all([text or "" for text in batch["text"]])
            for doc, missing, own in zip(batch["doc_id"], batch["doc_id"].isna(), found):
                ids = own + END
                for at in range(0, len(ids), 4 * length):
                    pieces.append((None if missing else int(doc), at // 4, ids[at : at + 4 * length]))
                    held += len(pieces[-1][2]) // 4
                    if held >= window_tokens:
                        yield packed(pieces)
                        pieces, held = [], 0
        words.forget()
        yield packed(pieces)

    bound_batches(df.sparkSession)
    rows = df.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"), F.col(f"`{text_col}`").alias("text"))
    return rows.mapInPandas(run, schema)
