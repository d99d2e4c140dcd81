"""Jaccard join of word n-grams with a token-group matrix.

Equal sets are one set.  The sets are sorted by two minimum hashes, so similar ones
stand together, and cut into groups of some hundred.  The matrix holds, for each
group, the union of its members' necessary tokens: with all tokens in one order,
rare ones first, two sets of similarity t share COMMON of their first
|S| - ceil(t |S|) + COMMON.  A set looks its own necessary tokens up in the matrix,
for groups whose sizes fit and that have COMMON of them.  A group found is bounded by
the set's overlap with the union of all its tokens; only groups that reach
ceil(t |S|) are opened and their members compared exactly.

A family of copies would meet itself in every one of its groups.  So links are
found in three steps, all exact: inside each group; from each set to the group that is
the first one for most of its tokens, which connects families; then between groups for pairs whose
sets are not connected yet; those sets are grouped anew and looked up group by group
first.  What is connected already needs no further link.

A token is a 64-bit hash of an n-gram; texts travel, tokens are made where they are
needed.
"""

from __future__ import annotations

import itertools
import math
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortlake.llm import arrays as A
from cohortlake.llm.common import blocks_for, connected, ready, stored
from cohortlake.llm.meeting import Once, meet
from cohortlake.operators.position import with_position

#: Sets of a group, and tokens of one (a longer set is a group of its own).
GROUP, GROUP_TOKENS = 128, 1 << 18
#: Counters of tokens, and the hash below which tokens are counted: a quarter of them,
#: about twice as many as are necessary.
SLOTS, COUNTED = 1 << 24, np.uint64(1 << 62)
#: Bytes of text of one sorted part; texts worked on at once.
PART_BYTES, SLICE = 8 << 20, 1000
#: Necessary tokens that two similar sets share at least: COMMON, or SHARE percent of the
#: smaller set where that is more (fewer where the sets have fewer).
COMMON, SHARE = 4, 3
#: Visitors that one task compares with a group before another task takes over.
VISITORS = 4096
_SEEDS = (np.uint64(0x5851F42D4C957F2D), np.uint64(0x14057B7EF767814F))


def token_sets(column, gram: int):
    """Distinct tokens of each text, sorted, end to end, and their offsets."""
    data, offsets = A.text_bytes(column)
    values, sizes = [], np.zeros(len(offsets) - 1, np.int64)
    for i, j in A.chunks(offsets):
        part = A.LOWER[data[offsets[i]:offsets[j]]]
        starts, ends, at = A.word_spans(part, offsets[i:j + 1] - offsets[i], ~A.SPACE)
        if not len(starts):
            continue
        words = A.span_hash(A.prefix_sums(A.BYTE_VALUE[part]), starts, ends)
        n = np.diff(at)
        width = np.minimum(n, gram)
        tokens = np.zeros(0, np.uint64)
        whose = np.repeat(np.arange(j - i), np.where(n >= gram, n - gram + 1, n > 0))
        place = A.ranges(at[:-1], np.where(n >= gram, n - gram + 1, n > 0).astype(np.int64))
        tokens = np.zeros(len(place), np.uint64)
        for k in np.unique(width[n > 0]).tolist():      # texts of fewer words: the whole sequence
            rows = width[whose] == k
            tokens[rows] = A.gram_hash(words, k)[place[rows]] + np.uint64(gram - k)
        order = np.lexsort((tokens, whose))
        tokens, whose = tokens[order], whose[order]
        new = np.append(True, (tokens[1:] != tokens[:-1]) | (whose[1:] != whose[:-1]))
        values.append(tokens[new])
        sizes[i:j] = np.bincount(whose[new], minlength=j - i)
    return (np.concatenate(values) if values else np.zeros(0, np.uint64)), np.append(0, np.cumsum(sizes))


def slot(tokens: np.ndarray, slots: int) -> np.ndarray:
    return (tokens >> np.uint64(20)).astype(np.int64) & (slots - 1)


def linkable(percent: int) -> int:
    """Size of the smallest set that can be similar to a different one."""
    return 1 if percent <= 50 else 1 << 62 if percent >= 100 else -(-percent // (100 - percent))


def needed(n, percent: int):
    """Overlap that a set of n tokens needs with a similar one."""
    return (n * percent + 99) // 100


def described(docs: DataFrame, gram: int, percent: int, slots: int, doc_id: str, text: str) -> DataFrame:
    """(doc_id, n, a, b, m1, m2, text, counts): size and 128-bit key of each row's set
    and its minimum hashes.  The text is kept with the first row of a set in a task, if
    it can be similar to another one.  Each task adds a row with the counts of the
    tokens of the sets kept."""
    ready(docs.sparkSession)
    least = linkable(percent)

    def run(batches):
        seen, counts = set(), np.zeros(slots, np.uint32)
        for batch in itertools.chain.from_iterable(
                (b.slice(i, SLICE) for i in range(0, b.num_rows, SLICE)) for b in batches):
            tokens, at = token_sets(batch.column(1), gram)
            n = np.diff(at)
            some = np.flatnonzero(n)
            keys = np.zeros((4, len(n)), np.uint64)
            if len(some):
                mixed = [A.mix(tokens ^ s) for s in _SEEDS]
                for row, (how, of) in enumerate([(np.add, mixed[0]), (np.add, mixed[1]),
                                                 (np.minimum, mixed[0]), (np.minimum, mixed[1])]):
                    keys[row, some] = how.reduceat(of, at[:-1][some])
            a, b, m1, m2 = keys.view(np.int64)
            keep = np.zeros(len(n), bool)
            for i in np.flatnonzero(n >= least).tolist():
                key = (int(a[i]), int(b[i]))
                if key not in seen:
                    seen.add(key)
                    keep[i] = True
            np.add.at(counts, slot(tokens[(tokens < COUNTED) & np.repeat(keep, n)], slots), 1)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(n), pa.array(a), pa.array(b), pa.array(m1), pa.array(m2),
                 batch.column(1).take(pa.array(np.arange(len(n)), mask=~keep)).cast(pa.string()),
                 pa.nulls(len(n), pa.binary())], names)
        if counts.any():
            at = np.flatnonzero(counts)
            blob = zlib.compress(np.diff(at, prepend=0).astype(np.uint32).tobytes() + counts[at].tobytes(), 1)
            yield pa.RecordBatch.from_arrays(
                [pa.nulls(1, pa.int64()), pa.array([-1]), *[pa.array([0]) for _ in range(4)], pa.nulls(1, pa.string()),
                 pa.array([blob], pa.binary())], names)

    names = ["doc_id", "n", "a", "b", "m1", "m2", "text", "counts"]
    return (docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"))
            .mapInArrow(run, "doc_id long, n long, a long, b long, m1 long, m2 long, text string, counts binary"))


def token_grades(rows: DataFrame, slots: int) -> np.ndarray:
    """How frequent the tokens of each slot are: a byte each, whatever the input (16 is
    the mean, where that is more)."""
    pieces = max(1, slots >> 16)

    def pack(total):
        blobs = [zlib.compress(part.tobytes(), 1) for part in np.split(total, pieces)]
        return pa.table({"piece": pa.array(np.arange(pieces, dtype=np.int32)), "counts": pa.array(blobs, pa.binary())})

    def add(batches):
        total = np.zeros(slots, np.int64)
        for batch in batches:
            for blob in batch.column(0).to_pylist():
                steps, counts = np.frombuffer(zlib.decompress(blob), np.uint32).reshape(2, -1)
                total[np.cumsum(steps, dtype=np.int64)] += counts
        yield from pack(total).to_batches()

    def total(held):
        count = sum(np.frombuffer(zlib.decompress(b), np.int64) for b in held.column("counts").to_pylist())
        return pa.table({"piece": held.column("piece")[:1], "counts": pa.array([zlib.compress(count.tobytes(), 1)], pa.binary())})

    counts = rows.where("counts is not null").select("counts")
    parts = math.ceil(math.sqrt(counts.rdd.getNumPartitions()))      # few tasks, each with as many counts to add
    found = (counts.coalesce(parts).mapInArrow(add, "piece int, counts binary").groupBy("piece")
             .applyInArrow(total, "piece int, counts binary").orderBy("piece").toArrow())
    counts = found.column("counts").to_pylist()
    mean = sum(int(np.frombuffer(zlib.decompress(b), np.int64).sum()) for b in counts) / slots
    grade = lambda c: np.minimum(c / max(1.0, mean / 16), 250).astype(np.uint8)  # noqa: E731  a piece at a time
    return np.concatenate([grade(np.frombuffer(zlib.decompress(b), np.int64)) for b in counts]) if counts else np.zeros(slots, np.uint8)


def token_order(tokens: np.ndarray, grades: np.ndarray) -> np.ndarray:
    """Places of the tokens in the order that all sets share: those counted first,
    rare ones before frequent ones, then the others; each by hash."""
    grade = np.where(tokens < COUNTED, grades[slot(tokens, len(grades))], 255)
    return np.lexsort((tokens, grade))


class Members:
    """A few sets as rows of a matrix over the union of their tokens."""

    def __init__(self, texts, gram: int):
        tokens, at = token_sets(texts, gram)
        self.n = np.diff(at)
        self.union, column = np.unique(tokens, return_inverse=True)
        self.has = np.zeros((len(self.n), len(self.union)), np.uint8)
        self.has[np.repeat(np.arange(len(self.n)), self.n), column] = 1
        self.tokens, self.at = tokens, at

    def places(self, tokens: np.ndarray) -> np.ndarray:
        """Columns of the tokens that the union has."""
        at = np.minimum(np.searchsorted(self.union, tokens), max(len(self.union) - 1, 0))
        return at[self.union[at] == tokens] if len(self.union) else at[:0]

    def similar(self, places: np.ndarray, n: int, percent: int) -> np.ndarray:
        """Members similar to a set of n tokens of which the union has ``places``."""
        both = self.has[:, places].sum(1, dtype=np.int64)
        return np.flatnonzero(100 * both >= percent * (self.n + n - both))


def _leaders(m: Members, percent: int) -> np.ndarray:
    """For each member the first one that it is connected with inside the group."""
    lead = np.arange(len(m.n))
    if len(lead) == 1:
        return lead
    several = m.has.sum(0, dtype=np.int64) > 1          # the others are in no intersection
    has = m.has[:, several].astype(np.float32 if len(m.union) < 1 << 24 else np.float64)
    both = np.rint(has @ has.T).astype(np.int64)
    near = 100 * both >= percent * (m.n[:, None] + m.n[None, :] - both)
    np.fill_diagonal(near, True)
    for i in range(1, len(lead)):
        joined = lead[:i + 1][near[i, :i + 1]]
        lead[np.isin(lead, joined)] = joined.min()
    return lead


def shared_least(n: int, percent: int, common: int) -> int:
    """Necessary tokens that a set of n shares with a similar one of its size or more."""
    return min(max(common, n * SHARE // 100), needed(n, percent))


def grouped(rows: DataFrame, grades: np.ndarray, gram: int, percent: int, parts: int, group: int,
            common: int) -> DataFrame:
    """(grp, uid, leader, n, a, b, text, first): the distinct sets in their groups;
    ``first`` are the necessary tokens."""
    shared = rows.sparkSession.sparkContext.broadcast(grades)

    def run(batches):
        from pyspark import TaskContext
        base, last, held, size = TaskContext.get().partitionId() << 40, None, [], 0
        done = 0

        def close():
            nonlocal done, held, size
            texts = pa.array([h[3] for h in held], pa.string())
            m = Members(texts, gram)
            lead = _leaders(m, percent)
            first = []
            for i, n in enumerate(m.n.tolist()):
                t = m.tokens[m.at[i]:m.at[i + 1]]
                p = n - needed(n, percent) + shared_least(n, percent, common)
                first.append(t[token_order(t, shared.value)[:p]].view(np.int64))
            uid = base + done + np.arange(len(held))
            out = pa.RecordBatch.from_arrays(
                [pa.array(np.full(len(held), base + done)), pa.array(uid), pa.array(uid[lead]), pa.array(m.n),
                 pa.array([h[0] for h in held], pa.int64()), pa.array([h[1] for h in held], pa.int64()), texts,
                 pa.array(first, pa.list_(pa.int64()))], names)
            done, held, size = done + len(held), [], 0
            return out

        for batch in batches:
            for row in zip(*[batch.column(i).to_pylist() for i in range(4)]):
                if row[:2] == last:
                    continue
                last = row[:2]
                if held and (len(held) >= group or size + row[2] > GROUP_TOKENS):
                    yield close()
                held.append(row)
                size += row[2]
        if held:
            yield close()

    names = ["grp", "uid", "leader", "n", "a", "b", "text", "first"]
    dealt = (rows.where("text is not null").select("a", "b", "n", "text", "m1", "m2")
             .repartitionByRange(parts, "m1", "m2", "a", "b").sortWithinPartitions("m1", "m2", "a", "b"))
    return (dealt.select("a", "b", "n", "text")
            .mapInArrow(run, "grp long, uid long, leader long, n long, a long, b long, text string, first array<long>"))


def _fits(percent: int):
    """Sizes of the set and of the group's members allow the similarity."""
    return (F.col("low") * percent <= F.col("n") * 100) & (F.col("n") * percent <= F.col("high") * 100)


def open_groups(sets: DataFrame, pairs: DataFrame, gram: int, percent: int, visitors_each: int) -> DataFrame:
    """Links (a, b) between the leaders of each set of ``pairs(uid, key)`` and of the
    members of group ``key`` that it is similar to, both among ``sets``."""
    least = F.greatest(F.lit(1), F.ceil(F.col("c") / visitors_each)).cast("long")
    load = pairs.groupBy("key").agg(F.count("*").alias("c")).select("key", least.alias("salts"))
    load = stored(load, "visited-groups")        # small tables are written, so Spark knows their size
    members = (sets.select(F.col("grp").alias("key"), "leader", "text").join(load, "key")
               .select("key", F.explode(F.sequence(F.lit(0).cast("long"), F.col("salts") - 1)).alias("salt"), "leader", "text"))
    visits = stored(pairs.join(load, "key").select("uid", "key", F.pmod(F.xxhash64("uid"), F.col("salts")).alias("salt")), "visits")
    visitors = visits.join(sets.select("uid", "leader", "text"), "uid").select("key", "salt", "leader", "text")
    group = Once(lambda t: Members(t.column("text"), gram))

    def work(held, passing):
        m, leaders = group(held), held.column("leader").to_numpy()
        tokens, at = token_sets(passing.column("text"), gram)
        out = []
        for own, i, j in zip(passing.column("leader").to_pylist(), at[:-1].tolist(), at[1:].tolist()):
            places = m.places(tokens[i:j])
            if len(places) >= needed(j - i, percent):           # the union's bound: else nothing inside can be similar
                out += [(own, int(x)) for x in np.unique(leaders[m.similar(places, j - i, percent)])]
        if out:
            yield pa.table({"a": [x for x, _ in out], "b": [x for _, x in out]})

    return meet(members, visitors, work, "a long, b long", 256).distinct()


def links(sets: DataFrame, gram: int, percent: int, visitors: int = VISITORS, common: int = COMMON, group: int = GROUP) -> DataFrame:
    """Links between leaders, enough to connect all similar sets."""
    tokens = sets.select(F.explode("first").alias("token"), "grp", "uid", "leader", "n")
    first = (tokens.groupBy("token").agg(F.min("grp").alias("key"), F.max("grp").alias("last"))
             .where("key <> last").select("token", "key"))
    # written first: where the tokens of several groups are few, their size lets Spark broadcast them
    tokens = stored(tokens.join(stored(first, "tokens-of-groups"), "token"), "shared-tokens", "zstd")

    def enough(size):       # as shared_least, for the smaller of two sets
        return F.least(F.greatest(F.lit(common), F.floor(size * SHARE / 100)), F.ceil(size * percent / 100))

    # a set can be similar to one of another group only if it has enough tokens of several groups
    able = tokens.groupBy("uid").agg(F.count("*").alias("c"), F.min("n").alias("n")).where(F.col("c") >= enough(F.col("n") * percent / 100)).select("uid")
    able = stored(able, "sets-with-tokens")
    tokens = tokens.join(able, "uid", "left_semi")
    # texts are shuffled here once, at every size of the table; what follows reads the chosen ones
    some = stored(sets.drop("first").join(able.hint("merge"), "uid", "left_semi"), "sets-to-compare", "zstd")
    star = (tokens.where("grp > key").groupBy("uid", "key").agg(F.min("n").alias("n"), F.count("*").alias("c"))
            .where(F.col("c") >= enough(F.col("n"))).groupBy("uid").agg(F.max_by("key", F.struct("c", -F.col("key"))).alias("key")))
    star = stored(star, "first-groups")
    found = stored(open_groups(some, star, gram, percent, visitors), "first-links")

    # what is not connected yet: tokens of several components, sets that have enough of them
    known = (tokens.drop("key").join(connected(found), F.col("leader") == F.col("node"), "left")
             .withColumn("whole", F.coalesce("component", "leader")).drop("node", "component"))
    for _ in range(2):
        several = known.groupBy("token").agg(F.min("whole").alias("x"), F.max("whole").alias("y")).where("x <> y").select("token")
        known = known.join(stored(several, "tokens-of-components"), "token", "left_semi")
        able = known.groupBy("uid").agg(F.count("*").alias("c"), F.min("n").alias("n")).where(F.col("c") >= enough(F.col("n") * percent / 100)).select("uid")
        known = known.join(stored(able, "sets-with-tokens"), "uid", "left_semi")
    known = stored(known, "other-tokens")
    # these sets are grouped anew by the token that most of them have, so a family stands together
    spread = known.groupBy("token").agg(F.count("*").alias("c"))
    by_token = known.join(spread, "token").groupBy("uid").agg(F.max(F.struct("c", "token"))["token"].alias("lead"))
    place = with_position(stored(by_token, "leading-tokens"), ["lead", "uid"], pos_col="at")
    regrouped = stored(place.select("uid", F.floor(F.col("at") / group).alias("grp")), "second-groups")
    known = stored(known.drop("grp").join(regrouped, "uid"), "grouped-tokens")
    # first between groups, so a family of copies costs the square of its groups at most;
    # tokens that the same groups have are looked up once and count as many
    sizes = stored(known.groupBy("grp").agg(F.min("n").alias("low"), F.max("n").alias("high"),
                                            F.min("whole").alias("w"), F.max("whole").alias("z")), "groups-apart")
    cells = stored(known.select("token", "grp").distinct(), "matrix")
    alike = (cells.groupBy("token").agg(F.sum(F.xxhash64("grp").cast("decimal(38,0)")).alias("x"), F.count("*").alias("y"))
             .groupBy("x", "y").agg(F.min("token").alias("token"), F.count("*").alias("weight")).drop("x", "y"))
    cells = cells.join(alike, "token").join(sizes, "grp")
    other = cells.select("token", F.col("grp").alias("key"), F.col("low").alias("low2"), F.col("high").alias("high2"),
                         F.col("w").alias("w2"), F.col("z").alias("z2"))
    fits = (F.col("low") * percent <= F.col("high2") * 100) & (F.col("low2") * percent <= F.col("high") * 100)
    apart = (F.col("w") != F.col("z2")) | (F.col("z") != F.col("w2"))
    pairs = (cells.join(other, "token").where((F.col("grp") >= F.col("key")) & fits & apart)
             .groupBy("grp", "key", "low", "low2", "high2").agg(F.sum("weight").alias("c"))
             .where((F.col("c") >= enough(F.least("low", "low2"))) | (F.col("grp") == F.col("key")))
             .select("grp", "key", F.col("low2").alias("low"), F.col("high2").alias("high")))
    rest = (known.select("uid", "grp", "n").distinct().join(stored(pairs, "group-pairs"), "grp").where(_fits(percent))
            .select("uid", "key"))
    some = some.drop("grp").join(regrouped, "uid")
    more = open_groups(some, stored(rest, "other-groups"), gram, percent, visitors)
    return found.unionByName(more)


def similar_components(docs: DataFrame, gram: int = 3, percent: int = 90, doc_id: str = "doc_id",
                       text: str = "text", group: int = GROUP, slots: int = SLOTS, visitors: int = VISITORS,
                       common: int = COMMON) -> DataFrame:
    """One row per row of ``docs``: (doc_id, n_shingles, component_id).

    A-Z count as lower case; words are runs without blanks; a text's set holds its
    distinct runs of ``gram`` words, or all its words as one where it has fewer.  Two
    texts link when 100 * intersection >= ``percent`` * union; component_id is the
    smallest doc_id reachable, the own one included.

    ``group``: sets of a group; ``slots`` (a power of two): counters for the order of
    tokens; ``visitors`` of a group for one task; ``common``: necessary tokens that
    candidates share.  They change time only.

    Null, empty and blank texts have no set and link with nothing, so their
    component is their own doc_id.  Rows that repeat stay; a null doc_id counts in no
    minimum (a component of such rows only has a null id).  A very long text is a
    group of its own.  Other columns are not read; an empty table gives an empty
    result."""
    if not 1 <= percent <= 100:
        raise ValueError("percent must be from 1 to 100")
    rows = stored(described(docs, gram, percent, slots, doc_id, text), "token-sets", "zstd")
    size = rows.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()[0]
    sets = stored(grouped(rows, token_grades(rows, slots), gram, percent, blocks_for(size, PART_BYTES), group, common),
                  "token-groups", "zstd")
    joined = connected(links(sets, gram, percent, visitors, common, group))
    classes = rows.where("n > 0").groupBy("a", "b").agg(F.min("doc_id").alias("least"))
    whole = (sets.select("a", "b", "leader").join(joined, F.col("leader") == F.col("node"), "left")
             .select("a", "b", F.coalesce("component", "leader").alias("component")))
    of = stored(classes.join(whole, ["a", "b"], "left"), "classes")
    smallest = of.where("component is not null").groupBy("component").agg(F.min("least").alias("smallest"))
    of = of.join(smallest, "component", "left").select("a", "b", F.when(F.col("component").isNull(), F.col("least"))
                                                       .otherwise(F.col("smallest")).alias("component_id"))
    some = (rows.where("n > 0").join(of, ["a", "b"])
            .select("doc_id", F.col("n").alias("n_shingles"), "component_id"))
    none = rows.where("n = 0").select("doc_id", F.col("n").alias("n_shingles"), F.col("doc_id").alias("component_id"))
    return some.unionByName(none)
