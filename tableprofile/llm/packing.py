"""Best-fit packing by a grouping genetic algorithm (Falkenauer's operators).

Documents become token ids; only those longer than a sequence are cut. A piece as long as
a sequence fills one alone. The others are dealt at random into blocks of a fixed number
of pieces, and each block is packed by several islands. An individual is a packing of the
block. Crossover injects whole well-filled sequences of one parent into the other, removes
the other's sequences that hold duplicates of injected pieces, and best-fits the displaced
pieces, longest first. After each epoch the best individual of an island moves to the next
island of its block by a join. Fitness is the mean square fill. An island stops early when
it needs no more sequences than the lengths together do.

Work and memory of a task are bounded by the block size; blocks grow in number only. Which
pieces share a block depends on hashes of row numbers, so copies of a row spread evenly.

Null text counts as empty; every document has at least the closing id. Ids (also null or
repeated) are carried along. An empty table gives no rows. Only id and text are read.
"""

from __future__ import annotations

import bisect
import re
import zlib
from collections.abc import Iterator
from unicodedata import is_normalized

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tableprofile.functions.checkpoints import cut_lineage
from tableprofile.llm.shared import by_size, kept_in_worker, mixed

CAPACITY = 2048
BLOCK_PIECES = 8192
ISLANDS = 2
EPOCHS = 2
POPULATION = 4
GENERATIONS = 6
CACHED_WORDS = 400_000
BATCH_BYTES = 2 << 20


_BLANKS = np.zeros(256, dtype=bool)
_BLANKS[[9, 10, 11, 12, 13, 32]] = True
_MASKS = np.array([(1 << (8 * k)) - 1 for k in range(9)], dtype=np.uint64)
_LONG = 32
# Letters, then marks other than the apostrophe, which can open an ending of its own.
_LETTERS_MARKS = re.compile(r"([^\W\d_]+)([!-&(-/:-@\[-`{-~]*)")


class WordIds:
    """Token ids of whole texts, by looking up the words of a batch at once.

    The tokenizer drops white space and never joins across it, so the ids of a text are
    those of its words in order; a full stop or comma between a letter and white space is a
    word of its own to it. Words are told apart by 64-bit hashes of their bytes, and only
    new ones go to the tokenizer. ASCII letters are lower-cased first, as it does itself;
    texts that may hold one of its special strings go through whole.
    """

    def __init__(self, path: str):
        import os

        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # one task, one core
        from tokenizers import Tokenizer, pre_tokenizers

        self.tokenizer = Tokenizer.from_file(path)
        # The same model without the steps that leave words of small letters as they are.
        self.plain = Tokenizer(self.tokenizer.model)
        self.plain.pre_tokenizer = pre_tokenizers.Sequence([
            pre_tokenizers.WhitespaceSplit(),
            pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False),
        ])
        vocabulary = self.tokenizer.get_vocab()
        self.closes = np.zeros(max(vocabulary.values()) + 1, dtype=bool)
        self.closes[[i for piece, i in vocabulary.items() if piece.endswith("</w>")]] = True
        self.forget()

    def forget(self) -> None:
        self.hashes = np.empty(0, dtype=np.uint64)  # sorted
        self.start = np.empty(0, dtype=np.int64)  # of the ids of each known word in flat
        self.count = np.empty(0, dtype=np.int64)
        self.flat = np.empty(0, dtype="<u4")

    def encode(self, texts: list[str | None]) -> list[bytes]:
        """Little-endian unsigned 32-bit ids of each text."""
        raw = [(text or "").encode("utf-8", "replace") for text in texts]
        whole = {i for i, data in enumerate(raw) if b"<|" in data}
        plain = [b"" if i in whole else data for i, data in enumerate(raw)]
        found = self._of_words(plain)
        for i in whole:
            ids = self.tokenizer.encode(texts[i], add_special_tokens=False).ids
            found[i] = np.array(ids, dtype="<u4").tobytes()
        return found

    def _of_words(self, raw: list[bytes]) -> list[bytes]:
        joined = b" ".join([b"", *raw, b""]).lower()
        codes = np.frombuffer(joined, dtype=np.uint8)
        blank = _BLANKS[codes]
        letter = (codes >= 97) & (codes <= 122)
        mark = (codes == 44) | (codes == 46)
        mark[1:-1] &= letter[:-2] & blank[2:]
        starts = np.flatnonzero(~blank[1:] & (blank[:-1] | mark[1:])) + 1
        ends = np.flatnonzero(~blank[:-1] & (blank[1:] | mark[1:])) + 1
        hashes = self._hashes(joined, starts, ends)
        order = np.argsort(hashes)
        ranked = hashes[order]
        first = np.r_[True, ranked[1:] != ranked[:-1]] if len(ranked) else np.empty(0, bool)
        kinds = ranked[first]
        kind = np.empty(len(hashes), dtype=np.int64)
        kind[order] = np.cumsum(first) - 1
        self._learn(joined, kinds, starts[order[first]], ends[order[first]])
        known = np.searchsorted(self.hashes, kinds)
        count = self.count[known][kind]
        stop = np.cumsum(count)
        shift = self.start[known][kind] - (stop - count)
        data = self.flat[np.repeat(shift, count) + np.arange(stop[-1] if len(stop) else 0)]
        data = data.tobytes()
        # The words of a text end where the next text begins.
        sizes = np.cumsum([0, *(len(x) + 1 for x in raw)])
        bounds = 4 * np.r_[0, stop][np.searchsorted(starts, sizes)]
        if len(self.hashes) > CACHED_WORDS:
            self.forget()
        return [data[a:b] for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist())]

    @staticmethod
    def _hashes(joined: bytes, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        import xxhash

        size = ends - starts
        padded = joined + bytes(_LONG + 8)
        loads = np.ndarray((len(joined) + _LONG,), dtype="<u8", buffer=padded, strides=(1,))
        total = mixed(size.astype(np.uint64), 1)
        at = np.arange(len(size))
        for k in range(_LONG // 8):
            at = at[size[at] > 8 * k]
            own = loads[starts[at] + 8 * k] & _MASKS[np.minimum(size[at] - 8 * k, 8)]
            total[at] = mixed(own ^ total[at], 2 + k)
        for i in np.flatnonzero(size > _LONG).tolist():
            total[i] = xxhash.xxh3_64_intdigest(joined[starts[i] : ends[i]])
        return total

    @staticmethod
    def _spelled(word: str) -> str | None:
        """Small letters, or small letters and ASCII marks with a space between; else None."""
        found = _LETTERS_MARKS.fullmatch(word)
        if not found:
            return None
        stem, marks = found.groups()
        if not stem.isalpha() or not (
            stem.isascii() or (stem == stem.lower() and is_normalized("NFC", stem))
        ):
            return None
        return f"{stem} {marks}" if marks else stem

    def _learn(self, joined: bytes, kinds, starts, ends) -> None:
        at = np.searchsorted(self.hashes, kinds)
        there = np.zeros(len(kinds), dtype=bool)
        if len(self.hashes):
            there = self.hashes[np.minimum(at, len(self.hashes) - 1)] == kinds
        new = np.flatnonzero(~there)
        if not len(new):
            return
        words = [
            joined[a:b].decode("utf-8") for a, b in zip(starts[new].tolist(), ends[new].tolist())
        ]
        spelled = [self._spelled(w) for w in words]
        ends_in = np.array([0 if w is None else 1 + (" " in w) for w in spelled])
        parts, counts = [], np.zeros(len(words), dtype=np.int64)
        easy_at, hard_at = np.flatnonzero(ends_in), np.flatnonzero(ends_in == 0)
        groups = [easy_at[k : k + 1024] for k in range(0, len(easy_at), 1024)]
        encoded = self.plain.encode_batch_fast(
            [" ".join([spelled[i] for i in own.tolist()]) for own in groups],
            add_special_tokens=False,
        )
        for own, found in zip(groups, encoded):
            ids = np.array(found.ids, dtype="<u4")
            # Each part of a word ends with the one token that closes a part.
            last = np.flatnonzero(self.closes[ids])[np.cumsum(ends_in[own]) - 1]
            counts[own] = np.diff(np.r_[-1, last])
            parts.append(ids)
        hard = self.tokenizer.encode_batch_fast(
            [words[i] for i in hard_at.tolist()], add_special_tokens=False
        )
        for i, found in zip(hard_at.tolist(), hard):
            counts[i] = len(found.ids)
            parts.append(np.array(found.ids, dtype="<u4"))
        # Ids lie in the order easy words, hard words.
        placed = np.r_[easy_at, hard_at]
        start = np.empty(len(words), dtype=np.int64)
        start[placed] = len(self.flat) + np.cumsum(counts[placed]) - counts[placed]
        self.flat = np.concatenate([self.flat, *parts])
        hashes = np.r_[self.hashes, kinds[new]]
        order = np.argsort(hashes)
        self.hashes = hashes[order]
        self.start = np.r_[self.start, start][order]
        self.count = np.r_[self.count, counts][order]


def token_pieces(
    docs: DataFrame,
    tokenizer_path: str,
    key: str = "doc_id",
    text: str = "text",
    capacity: int = CAPACITY,
    closing_id: int = 0,
) -> DataFrame:
    """One row for each piece: key, piece, start, length, ids_crc32."""
    source = docs.select(F.col(key), F.col(text).alias("_text"))
    kind = source.schema[0].dataType.simpleString()
    closing = np.array([closing_id], dtype="<u4").tobytes()

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = kept_in_worker(f"words {tokenizer_path}", lambda: WordIds(tokenizer_path))
        for batch in batches:
            for texts_of, texts in by_size(batch, BATCH_BYTES):
                at, piece, start, length, crc = [], [], [], [], []
                for row, found in enumerate(words.encode(texts)):
                    ids = found + closing
                    for i, cut in enumerate(range(0, len(ids), 4 * capacity)):
                        own = ids[cut : cut + 4 * capacity]
                        at.append(row)
                        piece.append(i)
                        start.append(i * capacity)
                        length.append(len(own) // 4)
                        crc.append(zlib.crc32(own))
                yield pa.RecordBatch.from_arrays(
                    [texts_of.column(0).take(pa.array(at, pa.int64())), pa.array(piece, pa.int32()),
                     pa.array(start, pa.int64()), pa.array(length, pa.int64()),
                     pa.array(crc, pa.int64())],
                    names=[key, "piece", "start", "length", "ids_crc32"],
                )

    schema = f"`{key}` {kind}, piece int, start long, length long, ids_crc32 long"
    return source.mapInArrow(rows, schema)


def best_fit(
    lengths: np.ndarray, items: np.ndarray, room: np.ndarray, bins: np.ndarray, capacity: int
) -> None:
    """Put ``items`` (longest first) where the least room stays; opens new bins.

    ``room`` is the room left in each open bin, ``bins`` the bin of every item; the bins
    of ``items`` are filled in, numbered on after the open ones.
    """
    order = np.argsort(room, kind="stable")
    spaces, names = room[order].tolist(), order.tolist()
    opened = len(room)
    for item, size in zip(items.tolist(), lengths[items].tolist()):
        at = bisect.bisect_left(spaces, size)
        if at == len(spaces):
            left, name = capacity - size, opened
            opened += 1
        else:
            left, name = spaces.pop(at) - size, names.pop(at)
        bins[item] = name
        if left:
            at = bisect.bisect_left(spaces, left)
            spaces.insert(at, left)
            names.insert(at, name)


def first_packings(
    lengths: np.ndarray, capacity: int, population: int, rng: np.random.Generator
) -> list[np.ndarray]:
    """Best fit of the lengths in descending order, and of orders disturbed a little."""
    found = []
    for i in range(population):
        noise = 1 if i == 0 else rng.uniform(1 - 0.05 * i, 1 + 0.05 * i, len(lengths))
        bins = np.full(len(lengths), -1, dtype=np.int32)
        items = np.argsort(-lengths * noise, kind="stable")
        best_fit(lengths, items, np.empty(0, np.int64), bins, capacity)
        found.append(bins)
    return found


def fill_of(lengths: np.ndarray, bins: np.ndarray) -> np.ndarray:
    return np.bincount(bins, weights=lengths).astype(np.int64)


def fitness(lengths: np.ndarray, bins: np.ndarray, capacity: int) -> tuple[float, float]:
    """Fewer bins first, then the mean square fill."""
    fill = fill_of(lengths, bins)
    return -float(len(fill)), float(np.mean((fill / capacity) ** 2))


def crossover(
    host: np.ndarray, donor: np.ndarray, lengths: np.ndarray, capacity: int,
    rng: np.random.Generator,
) -> np.ndarray:
    """A child: whole well-filled bins of the donor, the host's untouched bins, the rest by
    best fit."""
    fill = fill_of(lengths, donor)
    full = fill >= np.quantile(fill, 0.5)
    chosen = full & (rng.random(len(fill)) < rng.uniform(0.2, 0.6))
    injected = chosen[donor]
    hit = np.zeros(host.max() + 1, dtype=bool)
    hit[host[injected]] = True
    # Displacing the emptiest bin as well lets the child do with fewer bins.
    host_fill = fill_of(lengths, host)
    hit[np.argsort(host_fill, kind="stable")[: 1 + len(host_fill) // 50]] = True
    stays = ~hit[host] & ~injected
    child = np.full(len(lengths), -1, dtype=np.int32)
    _, child[injected] = np.unique(donor[injected], return_inverse=True)
    taken = int(child.max()) + 1
    if stays.any():
        _, again = np.unique(host[stays], return_inverse=True)
        child[stays] = taken + again
    placed = child >= 0
    room = capacity - fill_of(lengths[placed], child[placed]) if placed.any() else np.empty(0)
    waiting = np.flatnonzero(~placed)
    waiting = waiting[np.argsort(-lengths[waiting], kind="stable")]
    best_fit(lengths, waiting, room.astype(np.int64), child, capacity)
    return child


def evolve(
    population: list[np.ndarray], lengths: np.ndarray, capacity: int, generations: int,
    rng: np.random.Generator,
) -> list[np.ndarray]:
    """The population after some generations, best first."""
    rank = lambda bins: fitness(lengths, bins, capacity)
    least = -(-int(lengths.sum()) // capacity)
    scored = sorted(((rank(b), i, b) for i, b in enumerate(population)), reverse=True)
    born = len(scored)
    for _ in range(generations):
        if -scored[0][0][0] <= least or len(scored) < 2:
            break
        for _ in range(2):
            host, donor = rng.choice(len(scored), 2, replace=False)
            child = crossover(scored[host][2], scored[donor][2], lengths, capacity, rng)
            scored.append((rank(child), born, child))
            born += 1
        scored = sorted(scored, reverse=True)[: len(population)]
    return [bins for _, _, bins in scored]


_STATE = "block long, island int, lengths binary, population array<binary>, bins int"


def _state(block: int, island: int, lengths: np.ndarray, population: list[np.ndarray]) -> dict:
    return {
        "block": block, "island": island, "lengths": lengths.astype(np.int32).tobytes(),
        "population": [b.astype(np.int32).tobytes() for b in population],
        "bins": int(population[0].max()) + 1,
    }


def pack_pieces(
    pieces: DataFrame,
    capacity: int = CAPACITY,
    block_pieces: int = BLOCK_PIECES,
    islands: int = ISLANDS,
    epochs: int = EPOCHS,
    population: int = POPULATION,
    generations: int = GENERATIONS,
    seed: int = 4,
) -> DataFrame:
    """Add sequence_id and offset to rows with a ``length`` from 1 to ``capacity``."""
    names = pieces.columns
    rows = cut_lineage(pieces.withColumn("_row", F.monotonically_increasing_id()))
    short = rows.where(F.col("length") < capacity)
    blocks = max(1, -(-short.count() // block_pieces))
    short = short.withColumn("_block", F.pmod(F.xxhash64("_row", F.lit(seed)), F.lit(blocks)))
    parts = max(1, min(blocks * islands, 4 * pieces.sparkSession.sparkContext.defaultParallelism))

    def begin(key: tuple, df: pd.DataFrame) -> pd.DataFrame:
        lengths = np.sort(df["length"].to_numpy())[::-1]
        states = []
        for island in range(islands):
            rng = np.random.default_rng([seed, key[0], island])
            first = first_packings(lengths, capacity, population, rng)
            states.append(_state(key[0], island, lengths, first))
        return pd.DataFrame(states)

    state = short.select("_block", "length").groupBy("_block").applyInPandas(begin, _STATE)
    state = cut_lineage(state)
    for epoch in range(epochs):

        def step(batches: Iterator[pd.DataFrame], epoch: int = epoch) -> Iterator[pd.DataFrame]:
            for batch in batches:
                out = []
                for row in batch.itertuples():
                    lengths = np.frombuffer(row.lengths, np.int32).astype(np.int64)
                    own = [np.frombuffer(b, np.int32) for b in row.population]
                    if row.guest is not None:
                        own[-1] = np.frombuffer(row.guest, np.int32)  # in place of the worst
                    rng = np.random.default_rng([seed, row.block, row.island, epoch + 1])
                    grown = evolve(own, lengths, capacity, generations, rng)
                    out.append(_state(row.block, row.island, lengths, grown))
                yield pd.DataFrame(out)

        elite = state.select(
            "block", ((F.col("island") + 1) % islands).cast("int").alias("island"),
            F.col("population")[0].alias("guest"),
        )
        if epoch and islands > 1:
            joined = state.join(elite, ["block", "island"], "left")
        else:
            joined = state.withColumn("guest", F.lit(None).cast("binary"))
        spread = joined.repartition(parts, "block", "island")
        state = cut_lineage(spread.mapInPandas(step, _STATE))

    best = state.groupBy("block").agg(
        F.min_by(F.struct("lengths", F.col("population")[0].alias("best")),
                 F.struct("bins", "island")).alias("s")
    ).select(F.col("block").alias("_block"), "s.lengths", "s.best")

    def assign(_: tuple, df: pd.DataFrame, chosen: pd.DataFrame) -> pd.DataFrame:
        df = df.sort_values(["length", "_row"], ascending=[False, True], ignore_index=True)
        bins = np.frombuffer(chosen["best"].iloc[0], np.int32)
        order = np.lexsort((np.arange(len(bins)), bins))
        length = df["length"].to_numpy()[order]
        before = np.cumsum(length) - length
        first = np.r_[True, bins[order][1:] != bins[order][:-1]]
        offset = np.empty(len(df), dtype=np.int64)
        offset[order] = before - np.maximum.accumulate(np.where(first, before, 0))
        df["sequence_id"] = 2 * (df["_block"].to_numpy() * (1 << 32) + bins) + 1
        df["offset"] = offset
        return df[[*names, "sequence_id", "offset"]]

    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in pieces.schema.fields)
    packed = (
        short.groupBy("_block").cogroup(best.groupBy("_block"))
        .applyInPandas(assign, f"{fields}, sequence_id long, offset long")
    )
    alone = rows.where(F.col("length") == capacity).select(
        *names, (F.col("_row") * 2).alias("sequence_id"), F.lit(0).cast("long").alias("offset")
    )
    return packed.unionByName(alone)
