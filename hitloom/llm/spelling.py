"""Spelling variants, found in a frequency-vector trie.

Words are counted over all texts.  A word's letters fall into a few groups; its
vector is the count of letters in each group.  One inserted or replaced letter
adds at most one to one count and takes at most one from another, so the near
words of a word lie on the paths of a trie over these vectors that a
depth-first search reaches with a budget of one surplus and one deficit.  The
words at the leaves are verified letter by letter.

The trie is spread over the cluster: its first levels are walked as joins, one
level at a time, and only as deep as needed.  A node with few words is closed:
its subtree goes to one task.  Words that look for neighbours spend their
budget on the way down and are sent to each closed node that they reach, at most
once.  A node that still has too many words at the last level (all with one
vector) is dealt into chunks, and searchers go to each.  In a task the
search walks the subtree with a whole block of searchers at once: at each child
those go on whose budget allows it.

A word's length is the first level.  Words of the same length differ by a
replacement (one surplus, one deficit); of two words that differ by an insertion
the shorter one searches the next length with its surplus alone and both learn
of the pair.

Form and root follow from an aggregate of the pairs (combined map-side) and from
pointer doubling over the words that have a form.

Defined results: a null text has no words, a null doc_id counts as an empty
string in the hash; whole texts are read; repeated rows count as often as they
come; words of any length take part; of forms equally frequent the smallest in
code-point order counts; an empty table gives an empty result; other columns are
not looked at.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import cut, text_or_empty

LEAST_LENGTH = 7
LEAST_COUNT = 2
TIMES = 10
THINNED = 31  # one in so many words loses a letter
GROUPS = 16
NODE_WORDS = 50_000
NODE_LETTERS = 4_000_000
SEARCH_BLOCK = 100_000
DIRECT = 32_768  # words x searchers whose whole vectors are compared at once instead of walking on
PAIRS = 1_000_000
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
MOST_COUNT = 200  # counts are cut off here: equal counts stay equal and neighbours at most one apart


def word_counts(docs: DataFrame, least_length: int = LEAST_LENGTH, least_count: int = LEAST_COUNT, thinned: int = THINNED) -> DataFrame:
    """``docs`` (doc_id, text) -> word, n.  A word is a run of letters with A-Z lower-cased; where ``thinned``
    divides the crc32 of ``<doc_id>:<word>`` it loses the letter at that value modulo its length."""
    run = F.explode(F.regexp_extract_all(text_or_empty("text"), F.lit(r"[A-Za-zÀ-ÿ]{%d,}" % least_length), F.lit(0)))
    # lower() changes letters beyond A-Z too, and is much the cheaper where there are none.
    low = F.when(F.octet_length("run") == F.length("run"), F.lower("run")).otherwise(F.translate("run", UPPER, LOWER))
    runs = docs.select(F.col("doc_id"), run.alias("run")).withColumn("run", low)
    h = F.crc32(F.concat(F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.lit(":"), F.col("run")).cast("binary"))
    at = (F.col("h") % F.length("run")).cast("int")
    less = F.concat(F.expr("substring(run, 1, at)"), F.expr("substring(run, at + 2)"))
    word = F.when(F.col("h") % thinned == 0, less).otherwise(F.col("run"))
    return (runs.withColumn("h", h).withColumn("at", at).select(word.alias("word"))
            .where(F.length("word") >= least_length).groupBy("word").agg(F.count("*").alias("n")).where(F.col("n") >= least_count))


def letters(words: list[str] | pd.Series) -> tuple[np.ndarray, np.ndarray]:
    """Code points of all words, one after the other, and their lengths."""
    flat = np.frombuffer("".join(words).encode("utf-32-le", "surrogatepass"), np.uint32)
    return flat, np.fromiter(map(len, words), np.int64, len(words))


def vectors(flat: np.ndarray, lengths: np.ndarray, groups: int = GROUPS) -> np.ndarray:
    """Letters in each group: a to z in turn, all other characters by the same rule."""
    group = (flat.astype(np.int64) - ord("a")) % groups
    rows = np.repeat(np.arange(len(lengths)), lengths)
    return np.bincount(rows * groups + group, minlength=len(lengths) * groups).reshape(len(lengths), groups).clip(max=MOST_COUNT).astype(np.int16)


def unary(counts: np.ndarray) -> np.ndarray:
    """The first 16 counts in 64 bits, four each, as many set as the count says (at most four): the bits in
    which two words differ are at most the surplus and deficit between them."""
    some = np.minimum(counts[:, :16], 4).astype(np.uint64)
    place = np.uint64(4) * np.arange(some.shape[1], dtype=np.uint64)
    return np.bitwise_or.reduce(((np.uint64(1) << some) - np.uint64(1)) << place, axis=1)


def _with_vectors(words: DataFrame, groups: int) -> DataFrame:
    """word, n -> the same with len and sig, a string whose character i is chr(48 + count of group i)."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            if len(b):
                flat, lengths = letters(b["word"])
                sig = (vectors(flat, lengths, groups) + 48).astype(np.uint8)
                yield pd.DataFrame({"word": b["word"], "n": b["n"], "len": lengths.astype(np.int32),
                                    "sig": [bytes(row).decode("latin-1") for row in sig]})

    return words.mapInPandas(run, "word string, n long, len int, sig string")


def _verified(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Which pairs of rows (code points; ``b`` as long as ``a`` or one longer) differ by exactly one letter."""
    if a.shape[1] == b.shape[1]:
        return (a != b).sum(axis=1) == 1
    front, back = a == b[:, :-1], a == b[:, 1:]
    front = np.where(front.all(axis=1), a.shape[1], np.argmin(front, axis=1))
    back = np.where(back.all(axis=1), a.shape[1], np.argmin(back[:, ::-1], axis=1))
    return front + back >= a.shape[1]


def search(words: np.ndarray, counts: np.ndarray, asks: np.ndarray, ask_counts: np.ndarray, surplus: np.ndarray, deficit: np.ndarray,
           level: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Depth first through the trie of ``words`` (code points) with ``counts`` (vectors, sorted; equal before
    ``level``), all ``asks`` at once, each with its budget: (ask, word) indexes of verified pairs."""
    groups, todo = counts.shape[1], [(level, 0, len(words), np.arange(len(asks)), surplus, deficit)]
    bits, ask_bits = unary(counts), unary(ask_counts)
    most = 2 if asks.shape[1] == words.shape[1] else 1
    while todo:
        level, lo, hi, who, up, down = todo.pop()
        if level < groups and (hi - lo) * len(who) > DIRECT:
            have, want = counts[lo:hi, level], ask_counts[who, level]
            values, starts = np.unique(have, return_index=True)
            for value, start, end in zip(values, starts, [*starts[1:], hi - lo]):
                gap = value - want
                go = (gap == 0) | ((gap == 1) & (up > 0)) | ((gap == -1) & (down > 0))
                if go.any():
                    todo.append((level + 1, lo + start, lo + end, who[go], up[go] - (gap[go] == 1), down[go] - (gap[go] == -1)))
            continue
        step = max(1, PAIRS // (hi - lo))
        for at in range(0, len(who), step):
            some = who[at:at + step]
            i, j = np.nonzero(np.bitwise_count(ask_bits[some, None] ^ bits[None, lo:hi]) <= most)
            if len(i):
                i, j = some[i], lo + j
                ok = _verified(asks[i], words[j])
                if ok.any():
                    yield i[ok], j[ok]


def _routed(words: DataFrame, groups: int, node_words: int, node_letters: int) -> DataFrame:
    """``words`` (word, n, len, sig) -> node, depth, chunk, ask, word, n, up, down: each word at its closed
    node, and as a searcher at each closed node that it reaches."""
    step = lambda d: F.expr(f"substring(sig, {d}, 1)")
    rest = words.withColumn("node", F.concat(F.col("len").cast("string"), F.lit(":")))
    going = words.select("word", "n", "len", "sig", F.explode(F.array(
        F.struct(F.col("len").alias("to"), F.lit(1).alias("up"), F.lit(1).alias("down")),
        F.struct((F.col("len") + 1).alias("to"), F.lit(1).alias("up"), F.lit(0).alias("down")))).alias("x")) \
        .select("word", "n", "len", "sig", "x.up", "x.down", F.concat(F.col("x.to").cast("string"), F.lit(":")).alias("node"))
    home, asks = [], []
    for depth in range(groups + 1):
        last = depth == groups
        size = rest.groupBy("node").agg(F.count("*").alias("size"), F.max("len").alias("long"))
        most = F.greatest(F.lit(1), F.least(F.lit(node_words), F.floor(F.lit(node_letters) / F.col("long")))).cast("long")
        chunks = F.when(F.col("size") <= most, 1).when(F.lit(last), F.ceil(F.col("size") / most)).otherwise(0).cast("int")
        size = cut(size.select("node", chunks.alias("chunks")), "nodes")
        at = F.lit(depth).alias("depth")
        met = rest.join(size, "node")
        home.append(met.where("chunks > 0").select("node", at, F.pmod(F.xxhash64("word"), F.col("chunks")).cast("int").alias("chunk"),
                                                   F.lit(False).alias("ask"), "word", "n", F.lit(0).alias("up"), F.lit(0).alias("down")))
        reached = going.join(size, "node")
        asks.append(reached.where("chunks > 0").select("node", at, F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)).alias("chunk"),
                                                       F.lit(True).alias("ask"), "word", "n", "up", "down"))
        if last or size.where("chunks = 0").isEmpty():
            break
        rest = met.where("chunks = 0").select("word", "n", "len", "sig", F.concat("node", step(depth + 1)).alias("node"))
        count = F.ascii(step(depth + 1))
        option = lambda by, up, down: F.struct(F.char(count + by).alias("c"), (F.col("up") - up).alias("up"), (F.col("down") - down).alias("down"))
        ways = F.filter(F.array(option(0, 0, 0), option(1, 1, 0), option(-1, 0, 1)),
                        lambda w: (w["up"] >= 0) & (w["down"] >= 0) & (w["c"] >= F.lit("0")))
        going = reached.where("chunks = 0").select("word", "n", "len", "sig", "node", F.explode(ways).alias("w")) \
            .select("word", "n", "len", "sig", "w.up", "w.down", F.concat("node", "w.c").alias("node"))
    out = home[0]
    for x in [*home[1:], *asks]:
        out = out.unionByName(x)
    return out


def near_words(words: DataFrame, groups: int = GROUPS, node_words: int = NODE_WORDS, node_letters: int = NODE_LETTERS) -> DataFrame:
    """``words`` (word, n; each word once) -> word, near, near_n: both directions of every pair that
    differs by exactly one inserted, deleted or replaced code point."""
    routed = _routed(cut(_with_vectors(words, groups), "words"), groups, node_words, node_letters)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        cell, home, asks, waiting, index = None, [], [], 0, None

        def answers() -> Iterator[pd.DataFrame]:
            nonlocal index, asks, waiting
            if asks and home:
                if index is None:
                    own = pd.concat(home)
                    flat, lengths = letters(own["word"])
                    counts = vectors(flat, lengths, groups)
                    order = np.lexsort(counts.T[::-1])
                    index = own["word"].to_numpy()[order], own["n"].to_numpy()[order], flat.reshape(len(own), -1)[order], counts[order]
                names, ns, codes, counts = index
                block = pd.concat(asks)
                size = block["word"].str.len().to_numpy()
                for n in (codes.shape[1] - 1, codes.shape[1]):
                    some = block[size == n]
                    if len(some):
                        flat, lengths = letters(some["word"])
                        word, own_n = some["word"].to_numpy(), some["n"].to_numpy()
                        for i, j in search(codes, counts, flat.reshape(len(some), -1), vectors(flat, lengths, groups),
                                           some["up"].to_numpy(), some["down"].to_numpy(), cell[1]):
                            yield pd.DataFrame({"word": word[i], "near": names[j], "near_n": ns[j]})
                            if n < codes.shape[1]:  # the longer word doesn't search for the shorter one
                                yield pd.DataFrame({"word": names[j], "near": word[i], "near_n": own_n[i]})
            asks, waiting = [], 0

        for batch in batches:
            for key, part in batch.groupby(["node", "depth", "chunk"], sort=False):
                if key != cell:
                    yield from answers()
                    cell, home, index = key, [], None
                own = part[~part["ask"].astype(bool)]
                if len(own):
                    home.append(own)
                some = part[part["ask"].astype(bool)]
                if len(some):
                    asks.append(some)
                    waiting += len(some)
                    if waiting >= SEARCH_BLOCK:
                        yield from answers()
        yield from answers()

    dealt = routed.repartition("node", "depth", "chunk").sortWithinPartitions("node", "depth", "chunk", "ask")
    return dealt.mapInPandas(run, "word string, near string, near_n long")


def roots_of(links: DataFrame) -> DataFrame:
    """``links`` (word, form) without cycles -> word, root: forms followed to the last."""
    now = cut(links.select("word", F.col("form").alias("root")), "links")
    while True:
        then = cut(now.join(now.select(F.col("word").alias("root"), F.col("root").alias("beyond")), "root", "left")
                   .select("word", F.coalesce("beyond", "root").alias("root"), F.col("beyond").isNotNull().alias("moved")), "links")
        if then.where("moved").isEmpty():
            return then.select("word", "root")
        now = then.select("word", "root")


def spelling_variants(docs: DataFrame, least_length: int = LEAST_LENGTH, least_count: int = LEAST_COUNT, times: int = TIMES,
                      thinned: int = THINNED, groups: int = GROUPS, node_words: int = NODE_WORDS) -> DataFrame:
    """``docs`` (doc_id, text) -> word, form, root, n, n_near, form_n: for each word its most frequent near word,
    if that is at least ``times`` as frequent, and the word that its forms lead to in the end."""
    words = cut(word_counts(docs, least_length, least_count, thinned), "dictionary")
    best = F.min(F.struct((-F.col("near_n")).alias("order"), "near")).alias("best")
    near = near_words(words, groups, node_words).groupBy("word").agg(F.count("*").alias("n_near"), best)
    form_n: Column = -F.col("best.order")
    taken = form_n >= F.col("n") * times
    found = cut(words.join(near, "word", "left").select(
        "word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
        F.when(taken, F.col("best.near")).alias("form"), F.when(taken, form_n).alias("form_n")), "forms")
    roots = roots_of(found.where("form is not null"))
    return (found.join(roots, "word", "left")
            .select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n"))
