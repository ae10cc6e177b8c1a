"""Filling containers of fixed capacity with documents."""

from __future__ import annotations

from bisect import bisect_left, bisect_right

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from inkloom.llm.scans import running, unit_hash
from inkloom.runtime import broadcast_if

BLOCK = 256  # ranks of one size that are matched to places at once: at most as many places meet at most as many documents


def plan_containers(counts: dict[int, int], capacity: int) -> list[tuple[list[int], int]]:
    """(sizes in a container, number of such containers) that use up ``counts``.

    The instance is the histogram of sizes, so it is as small for billions of
    items as for thousands. Martello and Toth's reduction runs first: for the
    largest size j with room r = capacity - j it fixes {j} when nothing fits,
    {j, r} when that fills the container, {j, i} with the largest i <= r when
    no two other items fit into r together, and when none three fit and no pair
    in r is larger than i. A set that dominates no more fixes nothing; from then
    on the largest size is completed by best fit, and the reduction is tried
    again for the next. Equal containers are made at once, as often as the
    counts allow.
    """
    left = {s: n for s, n in counts.items() if n > 0 and 0 < s <= capacity}
    sizes = sorted(left)
    out: list[tuple[list[int], int]] = []

    def use(items: list[int]) -> None:
        need = {s: items.count(s) for s in items}
        times = min(left[s] // k for s, k in need.items())
        out.append((items, times))
        for s, k in need.items():
            left[s] -= k * times
            if not left[s]:
                del left[s]
                sizes.pop(bisect_left(sizes, s))

    def fits(room: int, taken: dict[int, int]) -> int | None:
        """The largest size up to ``room`` of which an item is left."""
        i = bisect_right(sizes, room) - 1
        while i >= 0 and left[sizes[i]] - taken.get(sizes[i], 0) <= 0:
            i -= 1
        return sizes[i] if i >= 0 else None

    def smallest(k: int, j: int) -> list[int]:
        """The k smallest items besides one of size j."""
        got: list[int] = []
        for s in sizes:
            n = left[s] - (s == j)
            got += [s] * min(n, k - len(got))
            if len(got) >= k:
                break
        return got

    while sizes:
        j = sizes[-1]
        room = capacity - j
        one = fits(room, {j: 1})
        if one is None:
            use([j])
            continue
        small = smallest(3, j)
        if one == room or len(small) < 2 or small[0] + small[1] > room:
            use([j, one])
            continue
        if (len(small) < 3 or sum(small) > room) and one >= _best_pair(sizes, left, j, room)[0]:
            use([j, one])
            continue
        items, taken = [j], {j: 1}
        while (nxt := fits(room, taken)) is not None:
            add = [nxt]
            if nxt != room and sum(small) > room:  # at most two more fit
                two = _best_pair(sizes, left, j, room, taken)
                add = list(two[1]) if two[0] > nxt else add
            for s in add:
                items.append(s)
                taken[s] = taken.get(s, 0) + 1
                room -= s
        use(items)
    return out


def _best_pair(sizes: list[int], left: dict[int, int], j: int, room: int, taken: dict[int, int] | None = None) -> tuple[int, tuple[int, ...]]:
    """The largest sum up to ``room`` of two items besides those taken, and its sizes."""
    taken = taken or {j: 1}
    lo, hi = 0, bisect_right(sizes, room) - 1
    best: tuple[int, tuple[int, ...]] = (0, ())
    while lo <= hi:
        a, b = sizes[lo], sizes[hi]
        free = lambda s: left[s] - taken.get(s, 0)
        if a + b > room:
            hi -= 1
        else:
            if a + b > best[0] and (free(a) >= 2 if a == b else free(a) >= 1 and free(b) >= 1):
                best = (a + b, (b, a))
                if best[0] == room:
                    return best
            lo += 1
    return best


def pack(sizes: DataFrame, caps: DataFrame, rows_each: int = 50_000) -> DataFrame:
    """Containers for all documents of ``sizes`` (doc_id, n_tokens), for each capacity.

    Columns: cap_name, container_id, doc_id, part_no, from_token, n_tokens. A
    document larger than the capacity becomes full parts with a container of
    their own and one rest; no other is divided. A document of 0 tokens takes
    no room and joins one of the containers (container 0 if there is no other).
    Repeated doc_ids are packed as often as they occur. Capacities that are null
    or below 1 give no rows.

    Only the histograms of sizes (at most ``capacity`` rows each) and the
    patterns go through the driver; documents are matched to places by size and
    block of ranks, with ranks from two-level running counts over ranges of about
    ``rows_each`` documents, so one frequent size is never in one task.
    """
    spark = sizes.sparkSession
    buckets = max(16, sizes.count() // rows_each)
    caps = caps.where("capacity_tokens >= 1").select("cap_name", F.col("capacity_tokens").cast("long").alias("cap")).distinct()
    items = sizes.select("doc_id", F.coalesce("n_tokens", F.lit(0)).cast("long").alias("n")).crossJoin(F.broadcast(caps))  # a few capacities
    full = F.when(F.col("n") > F.col("cap"), F.expr("n div cap")).otherwise(F.lit(0))
    items = items.withColumn("full", full).withColumn("rest", F.col("n") - F.col("full") * F.col("cap"))
    histogram = items.where("rest > 0").groupBy("cap_name", "cap", "rest").agg(F.count("*").alias("k"))
    by_cap: dict[tuple[str, int], dict[int, int]] = {}
    for r in histogram.collect():  # at most cap rows for each capacity
        by_cap.setdefault((r.cap_name, r.cap), {})[r.rest] = r.k
    slots, totals = [], []
    for (cap_name, cap), counts in sorted(by_cap.items()):
        first, used = 0, dict.fromkeys(counts, 0)
        for pattern, times in plan_containers(counts, cap):
            for s in dict.fromkeys(pattern):
                k = pattern.count(s)
                slots.append((cap_name, s, used[s], used[s] + k * times, first, k))
                used[s] += k * times
            first += times
        totals.append((cap_name, first))
    places = spark.createDataFrame(slots, "cap_name string, rest long, lo long, hi long, first long, k int")
    totals_df = spark.createDataFrame(totals, "cap_name string, containers long")

    ranked = running(items.where("rest > 0").withColumn("u", unit_hash("doc_id", F.lit(7))).withColumn("one", F.lit(1)), ["cap_name", "rest"], "u", "one", "rank", buckets)
    # places and documents of a size are cut into blocks of ranks: no task holds a whole size
    step = F.lit(BLOCK)
    blocks = places.withColumn("block", F.explode(F.sequence(F.expr(f"lo div {BLOCK}"), F.expr(f"(hi - 1) div {BLOCK}"))))
    rests = (
        ranked.withColumn("block", F.floor(F.col("rank") / step)).join(broadcast_if(blocks), ["cap_name", "rest", "block"]).where("rank >= lo and rank < hi")
        .select("cap_name", (F.col("first") + F.expr("(rank - lo) div k")).alias("container_id"), "doc_id", (F.col("full") + 1).cast("int").alias("part_no"), (F.col("full") * F.col("cap")).alias("from_token"), F.col("rest").alias("n_tokens"))
    )
    over = items.where("full > 0").withColumn("u", unit_hash("doc_id", F.lit(7)))
    over = running(over, ["cap_name"], "u", "full", "before", buckets).join(F.broadcast(totals_df), "cap_name", "left")
    fulls = over.select("cap_name", F.coalesce("containers", F.lit(0)).alias("c0"), "before", "cap", "doc_id", F.posexplode(F.sequence(F.lit(1), F.col("full").cast("int"))).alias("i", "part_no")).select(
        "cap_name", (F.col("c0") + F.col("before") + F.col("i")).alias("container_id"), "doc_id", "part_no", (F.col("i") * F.col("cap")).alias("from_token"), F.col("cap").alias("n_tokens")
    )
    empty = items.where("n = 0").join(F.broadcast(totals_df), "cap_name", "left").select(
        "cap_name", F.pmod(F.xxhash64("doc_id"), F.greatest(F.coalesce("containers", F.lit(1)), F.lit(1))).alias("container_id"), "doc_id", F.lit(1).alias("part_no"), F.lit(0).cast("long").alias("from_token"), F.lit(0).cast("long").alias("n_tokens")
    )
    return rests.unionByName(fulls).unionByName(empty)


def fill_report(packed: DataFrame, caps: DataFrame) -> DataFrame:
    """For each capacity: containers, documents, tokens, unused tokens and the share used."""
    per = packed.groupBy("cap_name", "container_id").agg(F.sum("n_tokens").alias("t"), F.count("*").alias("d"))
    return (
        per.groupBy("cap_name").agg(F.count("*").alias("containers"), F.sum("d").alias("parts"), F.sum("t").alias("tokens"), F.max("t").alias("fullest"))
        .join(caps.select("cap_name", "capacity_tokens"), "cap_name")
        .select("cap_name", "capacity_tokens", "containers", "parts", "tokens", "fullest", (F.col("containers") * F.col("capacity_tokens") - F.col("tokens")).alias("unused"), F.round(F.col("tokens") / (F.col("containers") * F.col("capacity_tokens")), 6).alias("used_share"))
    )
