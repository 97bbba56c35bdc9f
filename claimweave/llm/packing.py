"""Packing of token sequences: a grouping genetic algorithm on islands, with migration of the best."""

from __future__ import annotations

import random
import zlib
from array import array
from functools import partial, reduce

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F

from ..session import store_table
from .texts import chunks, joined, text_rows, with_null_ids, words

CAPACITY = 2048
END_ID = 0
TOKENIZER = "word_bpe_49k.json"
SHARD_PIECES = 4096  # pieces that one island packs
ISLANDS = 2
EPOCHS = 2
POPULATION = 5
GENERATIONS = 8
CACHED_WORDS = 1_000_000
CACHED_BYTES = 48

_ENCODERS: dict[str, "WordEncoder"] = {}


class WordEncoder:
    """Ids of a text, word by word.

    The tokenizer lowers letters and never joins characters over white space, nor a letter with a stop or comma,
    so the ids of a text are those of its lower-case words. Words met are kept, up to a fixed number.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.known: dict[bytes, bytes] = {}
        vocabulary = self.tokenizer.get_vocab()
        self.ends_word = np.zeros(max(vocabulary.values()) + 1, bool)
        self.ends_word[[i for t, i in vocabulary.items() if t.endswith("</w>")]] = True
        self.marks = {c: self.ids([bytes([c])])[0] for c in b".,"}

    def ids(self, words: list[bytes]) -> list[bytes]:
        found = self.tokenizer.encode_batch_fast([w.decode() for w in words], add_special_tokens=False)
        return [array("I", e.ids).tobytes() for e in found]

    def ids_of_letters(self, words: list[bytes]) -> list[bytes]:
        """Words of letters only are read as one text: each ends with a token that ends a word."""
        ids = np.array(self.tokenizer.encode_batch_fast([b" ".join(words).decode()], add_special_tokens=False)[0].ids, "<u4")
        cuts = np.flatnonzero(self.ends_word[ids]) + 1
        if len(cuts) != len(words):
            return self.ids(words)
        return [ids[a:b].tobytes() for a, b in zip([0, *cuts[:-1]], cuts)]

    def learn(self, missing: list[bytes]) -> None:
        stems = {w: w[:-1] for w in missing if w[-1] in self.marks and w[-2:-1].isalpha()}
        wanted = {stems.get(w, w) for w in missing}.difference(self.known)
        plain = [w for w in wanted if w.decode().isalpha()]
        other = list(wanted.difference(plain))
        for part, coded in ((plain, self.ids_of_letters), (other, self.ids)):
            if part:
                self.known.update(zip(part, coded(part)))
        for w, stem in stems.items():
            self.known[w] = self.known[stem] + self.marks[w[-1]]

    def encode(self, texts: list[bytes]) -> list[np.ndarray]:
        """Ids of each text. Equal words of the texts are looked up once."""
        if len(self.known) > CACHED_WORDS:
            self.known = {}
        # The strings of special tokens are lower case and begin with these two characters: such texts stay as they are.
        data, starts = joined([t if b"<|" in t else t.lower() for t in texts])
        at, lengths, hashes = words(data)
        _, first, which = np.unique(hashes, return_index=True, return_inverse=True)
        held = data.tobytes()
        keys = [held[a : a + n] for a, n in zip(at[first].tolist(), lengths[first].tolist())]
        if missing := [w for w in keys if w not in self.known]:
            self.learn(missing)
        coded = [self.known[w] for w in keys]
        for w in missing:
            if len(w) > CACHED_BYTES:
                del self.known[w]
        size = np.fromiter(map(len, coded), np.int64, len(coded)) // 4
        each = size[which]
        flat, offset, done = np.frombuffer(b"".join(coded), "<u4"), np.cumsum(size) - size, np.concatenate([[0], np.cumsum(each)])
        ids = flat[np.repeat(offset[which] - done[:-1], each) + np.arange(done[-1])]
        bounds = done[np.searchsorted(at, starts)]
        return [ids[a:b] for a, b in zip(bounds[:-1], bounds[1:])]


def encoder(name: str) -> WordEncoder:
    if name not in _ENCODERS:
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        import public_tokenizers

        _ENCODERS[name] = WordEncoder(name if os.sep in name else public_tokenizers.path(name))
    return _ENCODERS[name]


PIECES = "doc_id long, row long, piece int, start long, length long, ids_crc32 long"


def _cut(batches, name: str, capacity: int, end_id: int):
    coder, end = encoder(name), np.array([end_id], "<u4")
    for pdf in batches:
        texts = [t.encode() for t in pdf["text"]]
        docs, rows, out = pdf["doc_id"].tolist(), pdf["row"].tolist(), []
        for lo, hi in chunks(texts):
            for i, ids in enumerate(coder.encode(texts[lo:hi]), lo):
                ids = np.concatenate([ids, end])
                for k, start in enumerate(range(0, len(ids), capacity)):
                    part = ids[start : start + capacity]
                    out.append((docs[i], rows[i], k, start, len(part), zlib.crc32(part)))
        yield pd.DataFrame(out, columns=["doc_id", "row", "piece", "start", "length", "ids_crc32"])


def token_pieces(docs: DataFrame, tokenizer: str = TOKENIZER, capacity: int = CAPACITY, end_id: int = END_ID) -> DataFrame:
    """One row for each piece of each document: its ids and an end id, cut where longer than ``capacity``.

    Null text is empty: one piece of the end id alone. Repeated rows and null ids stay rows of their own, told
    apart by ``row``. ``tokenizer`` is a file name of the public set or a path.
    """
    rows = text_rows(docs).withColumn("row", F.monotonically_increasing_id())
    return with_null_ids(rows.mapInPandas(partial(_cut, name=tokenizer, capacity=capacity, end_id=end_id), PIECES))


class Bins:
    """Bins by what is free in them, with a bit for each amount that some bin has: best fit in a few steps."""

    def __init__(self, capacity: int):
        self.capacity, self.bits, self.items = capacity, 0, []
        self.by_free: list[list[int]] = [[] for _ in range(capacity + 1)]

    def add(self, items: list[int], free: int) -> None:
        self.by_free[free].append(len(self.items))
        self.bits |= 1 << free
        self.items.append(items)

    def put(self, item: int, length: int) -> None:
        fits = self.bits >> length
        if not fits:
            self.add([item], self.capacity - length)
            return
        free = length + (fits & -fits).bit_length() - 1
        at = self.by_free[free].pop()
        if not self.by_free[free]:
            self.bits ^= 1 << free
        self.items[at].append(item)
        left = free - length
        self.by_free[left].append(at)
        self.bits |= 1 << left


def best_fit(order: list[int], lengths: list[int], capacity: int, kept: list[list[int]] = ()) -> list[list[int]]:
    bins = Bins(capacity)
    for items in kept:
        bins.add(items, capacity - sum(lengths[i] for i in items))
    for i in order:
        bins.put(i, lengths[i])
    return bins.items


def worth(bins: list[list[int]], lengths: list[int], capacity: int) -> tuple[int, float]:
    """Fewer bins are better; among as many, unevenly filled ones, which are closer to losing one."""
    return len(bins), -sum((sum(lengths[i] for i in b) / capacity) ** 2 for b in bins)


def crossover(giver: list[list[int]], taker: list[list[int]], lengths: list[int], capacity: int, rng: random.Random) -> list[list[int]]:
    """Put well-filled bins of one parent into the other whole; best-fit what they displace, longest first."""
    full = sorted(giver, key=lambda b: -sum(lengths[i] for i in b))
    good = full[: max(1, len(full) // 2)]
    given = [b for b in good if rng.random() < 0.5] or good[:1]
    inside = {i for b in given for i in b}
    kept, loose = [], []
    for b in taker:
        if inside.isdisjoint(b):
            kept.append(list(b))
        else:
            loose += [i for i in b if i not in inside]
    loose.sort(key=lambda i: -lengths[i])
    return best_fit(loose, lengths, capacity, [list(b) for b in given] + kept)


def evolve(lengths: list[int], capacity: int, seed: int, elites: list[list[int]], population: int, generations: int) -> list[int]:
    """The bin number of each item after some generations; ``elites``: bin numbers that came from islands."""
    rng = random.Random(seed)
    least = -(-sum(lengths) // capacity)
    people = []
    for labels in elites:
        bins: dict[int, list[int]] = {}
        for i, b in enumerate(labels):
            bins.setdefault(b, []).append(i)
        people.append(list(bins.values()))
    while len(people) < population:
        noise = 0 if not people and not elites else 0.15 * rng.random()
        order = sorted(range(len(lengths)), key=lambda i: -lengths[i] * (1 + noise * rng.random()))
        people.append(best_fit(order, lengths, capacity))
        if len(people[-1]) == least:
            break
    scored = sorted(((worth(p, lengths, capacity), k, p) for k, p in enumerate(people)), key=lambda x: x[:2])
    for g in range(generations):
        if scored[0][0][0] == least or len(scored) < 2:
            break
        giver, taker = rng.sample(scored[: max(2, population - 1)], 2)
        child = crossover(giver[2], taker[2], lengths, capacity, rng)
        scored = sorted([*scored, (worth(child, lengths, capacity), population + g, child)], key=lambda x: x[:2])[:population]
    labels = [0] * len(lengths)
    for k, b in enumerate(scored[0][2]):
        for i in b:
            labels[i] = k
    return labels


def _epoch(batches, capacity: int, epoch: int, population: int, generations: int):
    for pdf in batches:
        best = []
        for r in pdf.itertuples():
            elites = [[int(x) for x in e] for e in r.elites]
            best.append(evolve([int(x) for x in r.lengths], capacity, hash((r.shard, r.island, epoch)), elites, population, generations))
        yield pd.DataFrame({"shard": pdf["shard"], "island": pdf["island"], "labels": best, "bins": [max(b, default=-1) + 1 for b in best]})


def pack_pieces(
    pieces: DataFrame,
    capacity: int = CAPACITY,
    shard_pieces: int = SHARD_PIECES,
    islands: int = ISLANDS,
    epochs: int = EPOCHS,
    population: int = POPULATION,
    generations: int = GENERATIONS,
) -> DataFrame:
    """Adds ``sequence_id`` and ``offset``: a place for each piece (``row``, ``piece``, ``length``) in a sequence.

    Pieces are dealt by hash to shards of about ``shard_pieces``, so no task grows with the input. Each shard is
    evolved on several islands; after each epoch an island also gets the best packing of its neighbour. The best
    of a shard's packings counts. Ties go to the lower island. No rows give no rows.
    """
    shards = max(1, -(-pieces.count() // shard_pieces))
    dealt = pieces.withColumn("shard", F.pmod(F.xxhash64("row", "piece"), F.lit(shards)))
    held = dealt.groupBy("shard").agg(F.sort_array(F.collect_list(F.struct("length", "row", "piece")), asc=False).alias("items"))
    held = store_table(held, "shards")
    each = held.select("shard", F.col("items.length").alias("lengths"), F.explode(F.sequence(F.lit(0), F.lit(islands - 1))).alias("island"))
    schema = "shard long, island int, labels array<int>, bins int"
    none = F.array().cast("array<array<int>>")
    # A shard that has as few bins as its sum of lengths allows needs no further search.
    total = F.aggregate("lengths", F.lit(0).cast("long"), lambda t, n: t + n)
    least = each.groupBy("shard").agg(F.first(F.ceil(total / capacity)).alias("least"))
    state, done = None, []
    for epoch in range(epochs):
        if state is None:
            start = each.withColumn("elites", none)
        else:
            near = state.select("shard", ((F.col("island") + 1) % islands).alias("island"), F.col("labels").alias("migrant"))
            own = state.select("shard", "island", "labels")
            start = each.join(own, ["shard", "island"]).join(near, ["shard", "island"])
            start = start.select("shard", "lengths", "island", F.array("labels", "migrant").alias("elites"))
        run = partial(_epoch, capacity=capacity, epoch=epoch, population=population, generations=generations)
        spread = start.select("shard", "island", "lengths", "elites").repartition(F.col("shard"), F.col("island"))
        evolved = store_table(spread.mapInPandas(run, schema), "islands")
        reached = evolved.groupBy("shard").agg(F.min("bins").alias("bins")).join(least, "shard").select("shard", (F.col("bins") <= F.col("least")).alias("met"))
        reached = store_table(reached, "reached")
        done.append(evolved.join(reached.where("met"), "shard", "left_semi"))
        state = evolved.join(reached.where("not met"), "shard", "left_semi")
        if reached.where("not met").isEmpty():
            break
    state = reduce(DataFrame.unionByName, [*done, state])
    best = state.groupBy("shard").agg(F.min_by("labels", F.struct("bins", "island")).alias("labels"))
    placed = held.join(best, "shard").select("shard", F.explode(F.arrays_zip("items", "labels")).alias("x"))
    placed = placed.select(
        F.col("x.items.row").alias("row"),
        F.col("x.items.piece").alias("piece"),
        F.col("x.items.length").alias("n"),
        (F.shiftleft(F.col("shard"), 32) + F.col("x.labels")).alias("sequence_id"),
    )
    before = "coalesce(sum(n) over (partition by sequence_id order by n desc, row, piece rows between unbounded preceding and 1 preceding), 0)"
    placed = placed.select("row", "piece", "sequence_id", F.expr(before).cast("long").alias("offset"))
    return pieces.join(placed, ["row", "piece"])


def pack_documents(docs: DataFrame, tokenizer: str = TOKENIZER, capacity: int = CAPACITY, end_id: int = END_ID) -> DataFrame:
    """Token pieces of all documents, packed into sequences of at most ``capacity`` ids."""
    pieces = store_table(token_pieces(docs, tokenizer, capacity, end_id), "pieces")
    packed = pack_pieces(pieces, capacity)
    return packed.select("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")
