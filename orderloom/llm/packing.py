"""Best-fit packing by linear grouping, planned on the histogram of lengths.

Pieces of one length are alike, so the plan needs only how many there are of each: at most ``capacity`` numbers reach the driver,
whatever the size of the table. There, large lengths are split into groups of equal cardinality and rounded up to the group's
longest; the few rounded lengths give a linear program over configurations (which lengths share a sequence), solved by column generation; the
whole part of those that fill a sequence (to ``full``) becomes sequences, the actual lengths take the places of the rounded ones, and the
rest, with all small lengths, is put best-fit, longest first. Everything is kept as runs of like sequences, so the plan has a few thousand rows. Spark then numbers the pieces of each
length, in blocks so that a common length is no single task, and each number finds its place in the plan.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from orderloom.llm.common import partitions

#: Borders tried between small lengths and large ones; at 1 all are small.
SMALLS = (1 / 4, 1 / 2, 1.0)
PLAN = "length long, first long, last long, sequence long, each long, base long"


@dataclass
class Plan:
    """Runs: pieces ``first`` to ``last`` - 1 of a length go to sequences from ``sequence`` on, ``each`` to one, from ``base`` on."""

    capacity: int
    runs: list[tuple[int, int, int, int, int, int]] = field(default_factory=list)
    sequences: int = 0
    gaps: dict[int, list[tuple[int, int]]] = field(default_factory=dict)
    taken: dict[int, int] = field(default_factory=dict)

    def put(self, length: int, count: int, sequence: int, each: int, base: int) -> None:
        first = self.taken.get(length, 0)
        self.taken[length] = first + count
        self.runs.append((length, first, first + count, sequence, each, base))

    def leave(self, gap: int, sequence: int, count: int) -> None:
        if count and gap:
            self.gaps.setdefault(gap, []).append((sequence, count))

    def best_fit(self, length: int, count: int) -> None:
        """Each piece goes where least room is left, new sequences open only when none has room."""
        while count:
            gap = min((g for g, open_runs in self.gaps.items() if g >= length and open_runs), default=None)
            if gap is None:
                gap, fresh = self.capacity, -(-count // (self.capacity // length))
                sequence, number = self.sequences, fresh
                self.sequences += fresh
            else:
                sequence, number = self.gaps[gap].pop()
            each, base = gap // length, self.capacity - gap
            full = min(number, count // each)
            if full:
                self.put(length, full * each, sequence, each, base)
                self.leave(gap - each * length, sequence, full)
                count -= full * each
            if full < number and count:
                self.put(length, count, sequence + full, each, base)
                self.leave(gap - count * length, sequence + full, 1)
                full, count = full + 1, 0
            self.leave(gap, sequence + full, number - full)


def _configurations(sizes: np.ndarray, demand: np.ndarray, capacity: int, full: float, rounds: int = 400) -> list[tuple[np.ndarray, int]]:
    """Whole part of the cheapest mix of configurations that covers the demand (column generation, revised simplex)."""
    m = sizes.size
    basis = np.diag((capacity // sizes).astype(float))
    for _ in range(rounds):
        amount = np.linalg.solve(basis, demand)
        price = np.linalg.solve(basis.T, np.ones(m))
        # Best value of a configuration at each total length, and the length added last.
        value, last = np.zeros(capacity + 1), np.full(capacity + 1, -1)
        for c in range(int(sizes.min()), capacity + 1):
            fit = np.flatnonzero(sizes <= c)
            offer = value[c - sizes[fit]] + price[fit]
            pick = int(np.argmax(offer))
            if offer[pick] > value[c - 1] + 1e-12:
                value[c], last[c] = offer[pick], fit[pick]
            else:
                value[c] = value[c - 1]
        if value[capacity] <= 1 + 1e-9:
            break
        column, c = np.zeros(m), capacity
        while c > 0:
            if last[c] < 0:
                c -= 1
                continue
            column[last[c]] += 1
            c -= int(sizes[last[c]])
        direction = np.linalg.solve(basis, column)
        with np.errstate(divide="ignore", invalid="ignore"):
            ratio = np.where(direction > 1e-9, amount / direction, np.inf)
        basis[:, int(np.argmin(ratio))] = column
    amount = np.linalg.solve(basis, demand)
    left, chosen = demand.copy(), []
    for j in range(m):
        uses = basis[:, j]
        need = uses > 0
        times = int(min(np.floor(amount[j] + 1e-7), np.min(np.floor(left[need] / uses[need]))))
        if times > 0 and uses @ sizes >= full * capacity:
            left -= times * uses
            chosen.append((uses.astype(int), times))
    return chosen


def plan(histogram: dict[int, int], capacity: int = 1024, groups: int = 256, smalls: Sequence[float] = SMALLS, full: float = 0.998) -> Plan:
    """Place ``histogram`` (length to count, lengths from 1 to ``capacity``) in the fewest sequences that any border of ``smalls`` gives.

    Where the border lies between large lengths and small ones, in shares of the capacity, decides how much is left to fill the gaps of the configurations;
    which is best hangs on the lengths. Beyond the largest length nothing is grouped, so the plan is never worse than best fit alone.
    """
    if any(not 1 <= length <= capacity for length, count in histogram.items() if count):
        raise ValueError("lengths must lie between 1 and the capacity")
    return min((_plan(histogram, capacity, groups, small, full) for small in smalls), key=lambda p: p.sequences)


def _plan(histogram: dict[int, int], capacity: int, groups: int, small: float, full: float) -> Plan:
    out = Plan(capacity)
    remaining = {length: count for length, count in histogram.items() if count}
    large = sorted((x for x in remaining if x > small * capacity), reverse=True)
    if large:
        total = sum(remaining[x] for x in large)
        edges = [total * (g + 1) // groups for g in range(groups)]
        queues: list[list[list[int]]] = []
        at = g = 0
        opened = False
        for length in large:
            count = remaining[length]
            while count:
                while at >= edges[g]:
                    g, opened = g + 1, False
                if not opened:
                    if queues and queues[-1][0][0] == length:
                        pass  # the same rounded length: one group
                    else:
                        queues.append([])
                    opened = True
                step = min(count, edges[g] - at)
                queues[-1].append([length, step])
                at, count = at + step, count - step
        sizes = np.array([q[0][0] for q in queues])
        demand = np.array([sum(n for _, n in q) for q in queues], dtype=float)
        for uses, times in _configurations(sizes, demand, capacity, full):
            slots = [i for i, n in enumerate(uses) for _ in range(n)]
            lists = []
            for i in slots:
                need, own = times, []
                while need:
                    step = min(need, queues[i][0][1])
                    own.append((queues[i][0][0], step))
                    queues[i][0][1] -= step
                    need -= step
                    if not queues[i][0][1]:
                        queues[i].pop(0)
                lists.append(own)
            _fill(out, lists, times, remaining)
    for length in sorted(remaining, reverse=True):
        out.best_fit(length, remaining[length])
    return out


def _fill(out: Plan, lists: list[list[tuple[int, int]]], times: int, remaining: dict[int, int]) -> None:
    """``times`` sequences of one configuration; the actual lengths of a slot change along them, so they part into like runs."""
    begin = out.sequences
    out.sequences += times
    places, left, done = [0] * len(lists), [own[0][1] for own in lists], 0
    while done < times:
        step, base = min(left), 0
        for i, own in enumerate(lists):
            length = own[places[i]][0]
            out.put(length, step, begin + done, 1, base)
            remaining[length] -= step
            base += length
            left[i] -= step
            if not left[i] and places[i] + 1 < len(own):
                places[i] += 1
                left[i] = own[places[i]][1]
        out.leave(out.capacity - base, begin + done, step)
        done += step


def pack(pieces: DataFrame, order: list[str], capacity: int = 1024, length: str = "length") -> DataFrame:
    """``pieces`` with ``sequence_id`` and ``offset``; pass a written table, it is read twice.

    ``order`` names columns that tell rows apart; rows that agree in all of them and in length are interchangeable. Lengths are 1 to
    ``capacity``: others, and null, are an error. Sequences are numbered from 0 without gaps and filled from place 0 without gaps. An empty table
    stays empty. Columns named like an output are replaced.
    """
    spark = pieces.sparkSession
    own = [c for c in pieces.columns if c not in ("sequence_id", "offset")]
    histogram = {r[0]: r[1] for r in pieces.groupBy(length).count().collect()} if pieces.columns else {}
    placed = plan(histogram, capacity)
    blocks = partitions(spark)
    dealt = pieces.select(*own, F.pmod(F.xxhash64(*order), F.lit(blocks)).alias("_block"))
    before = Window.partitionBy(length).orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    counts = dealt.groupBy(length, "_block").agg(F.count("*").alias("_rows"))
    counts = counts.select(F.col(length).alias("_of"), F.col("_block").alias("_in"), F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_before"))
    number = F.row_number().over(Window.partitionBy(length, "_block").orderBy(*order))
    ranked = dealt.select("*", (number - 1).cast("long").alias("_number"))
    ranked = ranked.join(counts, (ranked[length] == counts["_of"]) & (ranked["_block"] == counts["_in"]))
    ranked = ranked.select(*own, (F.col("_number") + F.col("_before")).alias("_rank"))
    # A plan has a few runs per length at most and lengths are bounded by the capacity, so its size is bounded too.
    runs = F.broadcast(spark.createDataFrame(placed.runs, PLAN).select(*[F.col(c.split()[0]).alias(f"_{c.split()[0]}") for c in PLAN.split(", ")]))
    found = ranked.join(runs, (ranked[length] == runs["_length"]) & (F.col("_rank") >= F.col("_first")) & (F.col("_rank") < F.col("_last")))
    inside = F.col("_rank") - F.col("_first")
    return found.select(
        *own,
        (F.col("_sequence") + F.floor(inside / F.col("_each")).cast("long")).alias("sequence_id"),
        (F.col("_base") + inside % F.col("_each") * F.col(length)).alias("offset"),
    )


def sequences(packed: DataFrame, ids: str = "ids") -> DataFrame:
    """The packed sequences themselves: ``sequence_id``, ``length`` and ``ids`` joined in order (at most ``capacity`` tokens each)."""
    parts = F.sort_array(F.collect_list(F.struct("offset", F.hex(ids).alias("ids"))))
    whole = packed.groupBy("sequence_id").agg(F.sum("length").alias("length"), parts.alias("_parts"))
    return whole.select("sequence_id", "length", F.unhex(F.array_join(F.transform("_parts", lambda p: p["ids"]), "")).alias("ids"))
