"""Ordered matching of invoices against settled claims: the first rule that hits wins.

Every rule turns an invoice into probes (rule, key, as_of, low, high) and a claim into
entries (rule, key, since, value).  Where a key holds at most ``FEW`` claims a probe
meets them one by one.  In a crowded key invoices and claims are never paired: a probe
is answered by what its key had accumulated up to its date: how many claims, the best
one, and the best one of a different invoice number.  These accumulate over a
timeline with at most three rows per key and date, so a key that holds a third of
all claims still costs one short timeline.  Only there intervals are cut into pieces.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import freed_shuffles
from ..sources.incremental import discard, written
from .dedup import top_per_key

_SEPARATOR = "\u0001"
_ALWAYS = "0001-01-01"
_FOREVER = "9999-12-31"
# days of two thousand years make at most 90 pieces
BLOCKS = tuple(8 ** n for n in range(7))
#: Claims of a key that a probe may meet one by one; an interval of a crowded key makes about as many pieces.
FEW = 32
#: Claims whose entries a task compares at once, and up to how many such tasks Spark may lay out as it likes and all rules run at once.
TASK_CLAIMS, FEW_TASKS = 1 << 17, 8


@dataclass(frozen=True)
class MatchRule:
    """One step of the waterfall.

    probe_keys / claim_keys  columns that must be equal; a null never matches
    probe_where / claim_where  which rows take part
    dated     the claim must be settled on or before the invoice's date
    unique    ids with more than one match are released to the later rules
    between   (lowest, highest, value): the whole number ``value`` of the claim must lie in
              the invoice's closed interval.  The invoice lists the blocks that make up its
              interval, the claim the blocks that hold its value.
    widths    widths of the blocks, each a multiple of the one before; the first is 1
    """

    rank: int
    message: str
    probe_keys: tuple[Column, ...]
    claim_keys: tuple[Column, ...]
    probe_where: Column | None = None
    claim_where: Column | None = None
    dated: bool = True
    unique: bool = False
    between: tuple[Column, Column, Column] | None = None
    widths: tuple[int, ...] = BLOCKS


def _key(parts: list[Column]) -> Column:
    joined = []
    for part in parts:
        joined += [part.cast("string"), F.lit(_SEPARATOR)]
    return F.concat(*joined)


def _units(low: Column, end: Column) -> Column:
    """low, low + 1, ..., end - 1; nothing when the interval is empty."""
    return F.when(low < end, F.sequence(low, end - 1)).otherwise(F.array().cast("array<bigint>"))


def _cover(low: Column, high: Column, widths: tuple[int, ...]) -> Column:
    """Names of disjoint pieces that make up [low, high]: the widest blocks that fit, narrower ones at both ends.

    With ratios of 8 an interval has at most 14 pieces of a width, whatever its length.
    """
    named = lambda n: lambda v: F.concat(F.lit(f"{n}:"), v.cast("string"))
    first = [F.ceil(low / w) for w in widths]
    end = [F.floor((high + 1) / w) for w in widths]
    pieces = []
    for n, w in enumerate(widths):
        whole = _units(first[n], end[n])
        if n + 1 < len(widths):
            ratio = widths[n + 1] // w
            inner = first[n + 1] < end[n + 1]
            ends = F.concat(_units(first[n], first[n + 1] * ratio), _units(end[n + 1] * ratio, end[n]))
            whole = F.when(inner, ends).otherwise(whole)
        pieces.append(F.transform(whole, named(n)))
    return F.concat(*pieces)


def _pieces(value: Column, widths: tuple[int, ...]) -> list[Column]:
    """Every piece a value belongs to."""
    return [F.concat(F.lit(f"{n}:"), F.floor(value / w).cast("string")) for n, w in enumerate(widths)]


def _entry(rule: MatchRule, parts: tuple[Column, ...], **more: Column) -> Column:
    return F.struct(F.lit(rule.rank).alias("rule"), _key(list(parts)).alias("key"), *[c.alias(n) for n, c in more.items()])


def _probe_entry(rule: MatchRule, as_of: Column) -> Column:
    """The probe of an invoice; without an interval it asks for the value 0, which all claims of such a rule have."""
    low, high, _ = rule.between or (F.lit(0),) * 3
    date = as_of if rule.dated else F.lit(_FOREVER).cast("date")
    return _entry(rule, rule.probe_keys, as_of=date, low=low.cast("bigint"), high=high.cast("bigint"))


def _probes(invoices: DataFrame, rules: list[MatchRule], as_of: Column, id: str, own: str) -> DataFrame:
    takes_part = lambda r: F.lit(True) if r.probe_where is None else r.probe_where
    entry = F.explode(F.array(*[F.when(takes_part(r), _probe_entry(r, as_of)) for r in rules]))
    if len(rules) == 1:  # no array, so that constants of the rule are not shuffled
        invoices, entry = invoices.where(takes_part(rules[0])), _probe_entry(rules[0], as_of)
    rows = invoices.select(F.col(id).alias("id"), F.col(own).alias("own"), entry.alias("e")).select("id", "own", "e.*")
    return rows.where(F.col("key").isNotNull() & F.col("as_of").isNotNull() & (F.col("low") <= F.col("high")))


def _claim_entry(rule: MatchRule, since: Column) -> Column:
    value = rule.between[2] if rule.between else F.lit(0)
    date = since if rule.dated else F.lit(_ALWAYS).cast("date")
    entry = _entry(rule, rule.claim_keys, since=date, value=value.cast("bigint"))
    return entry if rule.claim_where is None else F.when(rule.claim_where, entry)


def _explode(df: DataFrame, entries: list[Column], date: str, *keep: Column) -> DataFrame:
    rows = df.select(*keep, F.explode(F.array(*entries)).alias("e")).select("*", "e.*").drop("e")
    return rows.where(F.col("key").isNotNull() & F.col(date).isNotNull())


def _disjoint(probes: DataFrame, rules: list[MatchRule]) -> DataFrame:
    """Probes without repeats: of what several of one invoice, key and date ask for, each value is left to one of them."""
    if all(r.between is None for r in rules):
        return probes.distinct()
    same = Window.partitionBy("id", "own", "rule", "key", "as_of").orderBy("low", "high")
    upto = F.max("high").over(same.rowsBetween(Window.unboundedPreceding, -1))
    return probes.withColumn("low", F.greatest("low", upto + 1)).where(F.col("low") <= F.col("high"))


def _in_pieces(df: DataFrame, rules: list[MatchRule], pieces) -> DataFrame:
    """One row per piece of a row's interval or value, with the piece in its key."""
    named = F.array(F.lit(""))
    for rule in rules:
        if rule.between is not None:
            named = F.when(F.col("rule") == rule.rank, pieces(rule.widths)).otherwise(named)
    return df.withColumn("__piece", F.explode(named)).withColumn("key", F.concat("key", "__piece")).drop("__piece", "low", "high", "value")


def _probe_pieces(probes: DataFrame, rules: list[MatchRule]) -> DataFrame:
    return _in_pieces(probes, rules, lambda widths: _cover(F.col("low"), F.col("high"), widths))


def _claim_pieces(entries: DataFrame, rules: list[MatchRule]) -> DataFrame:
    return _in_pieces(entries, rules, lambda widths: F.array(*_pieces(F.col("value"), widths)))


def accumulate(probes: DataFrame, entries: DataFrame, other: str, best: Column) -> DataFrame:
    """Answer each (rule, key, as_of): n, the best entry, the two best of different ``other``.

    ``best`` is a struct whose first fields order the entries; it must hold ``other``.
    """
    at = ["rule", "key", "since"]
    per_other = (entries.withColumn("b", best).groupBy(*at, other)
                 .agg(F.count(F.lit(1)).alias("n"), F.max("b").alias("b")))
    per_date = (per_other.groupBy(*at).agg(F.sum("n").alias("n"), F.max("b").alias("top"))
                .select("rule", "key", F.col("since").alias("at"), F.lit(0).alias("kind"), "n", "top"))
    two = (top_per_key(per_other.where(F.col(other).isNotNull()), at, [F.desc("b")], 2)
           .select("rule", "key", F.col("since").alias("at"), F.lit(0).alias("kind"), "b"))
    asked = (probes.select("rule", "key", F.col("as_of").alias("at")).distinct()
             .withColumn("kind", F.lit(1)))
    timeline = (per_date.unionByName(two, allowMissingColumns=True)
                .unionByName(asked, allowMissingColumns=True))
    run = Window.partitionBy("rule", "key").orderBy("at", "kind", F.asc_nulls_first("b"))
    upto, before = (run.rowsBetween(Window.unboundedPreceding, 0), run.rowsBetween(Window.unboundedPreceding, -1))
    state = timeline.select("*", F.sum("n").over(upto).alias("n_upto"), F.max("top").over(upto).alias("best"),
                            F.max("b").over(upto).alias("first"), F.max("b").over(before).alias("held"))
    # the one pushed out of first place, unless it belongs to the same invoice number
    loser = F.when(F.col(f"held.{other}") != F.col(f"b.{other}"), F.least("held", "b"))
    state = state.select("*", F.max(loser).over(upto).alias("second"))
    return (state.where((F.col("kind") == 1) & (F.col("n_upto") > 0))
            .select("rule", "key", F.col("at").alias("as_of"), F.col("n_upto").alias("n"),
                    "best", "first", "second"))


def match_waterfall(invoices: DataFrame, claims: DataFrame, rules: list[MatchRule], *, id: str, own: str,
                    as_of: Column, since: Column, other: str, payload: list[str], newest: list[str],
                    void_after_null_id: bool = True) -> DataFrame:
    """(id, rule, n_matches, best, best_other) for every invoice that matches a rule.

    best        the newest matching claim of the winning rule
    best_other  the newest one whose invoice number differs from the invoice's own
    newest      payload columns ordering the claims (largest wins); the rest of the
                payload breaks ties
    A null id that matches a rule voids all later rules, as NOT IN does.  Claims are shuffled once before the rules
    multiply them: copies of an entry share their payload, so they need no shuffle of their own.  The entries are written
    once.  Few rows meet all rules at once.  Else rules follow each other: an invoice that a rule has matched asks no later
    one, what a rule finds is written, and the disk of its shuffles is free for the next.  Only what was found stays at the end.
    """
    scratch: list[DataFrame] = []

    def kept(df: DataFrame, name: str) -> DataFrame:
        scratch.append(written(df, name))
        return scratch[-1]

    with freed_shuffles(invoices.sparkSession):
        # Spark lays out few tasks by their compressed size; many follow the rows, so that a task's entries take bounded memory
        tasks = claims.count() // TASK_CLAIMS
        dealt = claims.repartition(tasks, *payload) if tasks > FEW_TASKS else claims.repartition(*payload)
        entries = _explode(dealt, [_claim_entry(r, since) for r in rules], "since", *[F.col(c) for c in payload])
        entries = kept(entries.where(F.col("value").isNotNull()).distinct(), "waterfall-entries")
        # keys are counted by hash: one taken for crowded by a collision is answered by its timeline, which is as exact
        crowds = kept(entries.groupBy("rule", F.xxhash64("rule", "key").alias("__crowd")).agg(F.count(F.lit(1)).alias("n_claims"))
                      .where(F.col("n_claims") > FEW).select("rule", "__crowd"), "waterfall-crowds")
        crowded = {r.rule for r in crowds.select("rule").distinct().collect()}  # at most one row per rule
        ordered = sorted(rules, key=lambda r: r.rank)
        asking = invoices.agg(F.count(F.lit(1)).alias("all"), F.count(F.col(id)).alias("named")).first()
        if void_after_null_id and asking["named"] < asking["all"]:
            nameless = kept(_disjoint(_probes(invoices.where(F.col(id).isNull()), ordered, as_of, id, own), ordered), "waterfall-nameless")
            void = _first_rule_of_null_ids(nameless, entries, rules)
            ordered = [r for r in ordered if void is None or r.rank <= void]

        newest_first = F.struct(*newest, *[c for c in payload if c not in newest])
        left, reduced = invoices.where(F.col(id).isNotNull()), False
        found: list[DataFrame] = []
        taken: list[DataFrame] = []  # ids found since the invoices left were written
        steps = [[r] for r in ordered] if max(tasks, asking["named"] // TASK_CLAIMS) > FEW_TASKS else [ordered]
        for n, step in enumerate(steps):
            probes = _probes(left, step, as_of, id, own)
            if taken:
                probes = probes.join(reduce(DataFrame.unionByName, taken).hint("merge"), "id", "left_anti")
            ranks = [r.rank for r in step]
            crowd = crowds.where(F.col("rule").isin(ranks)).select("__crowd") if crowded.intersection(ranks) else None
            mark = len(scratch)
            hits = _hits(_disjoint(probes, step), entries.where(F.col("rule").isin(ranks)), crowd, step, other, newest_first, kept)
            hits = hits.groupBy("id", "rule").agg(F.sum("n").alias("n_matches"), F.max("best").alias("best"), F.max("best_other").alias("best_other"))
            unique = [r.rank for r in step if r.unique]
            if unique:
                hits = hits.where(~F.col("rule").isin(unique) | (F.col("n_matches") == 1))
            if len(step) > 1:
                hits = top_per_key(hits, ["id"], [F.asc("rule")])
            found.append(written(hits, "waterfall-found"))
            discard(*scratch[mark:])
            del scratch[mark:]
            ids, later = found[-1].select("id"), [r for later in steps[n + 1:] for r in later]
            if reduced:
                taken.append(ids)
            elif later and not ids.isEmpty():
                left, reduced = kept(_left(left, ids, later, as_of, id, own), "waterfall-left"), True
    discard(*scratch)
    return reduce(DataFrame.unionByName, found)


def _hits(probes: DataFrame, entries: DataFrame, crowd: DataFrame | None, rules: list[MatchRule], other: str, best: Column,
          kept: Callable[[DataFrame, str], DataFrame]) -> DataFrame:
    """(id, rule, n, best, best_other) of the probes that meet claims; ``crowd`` has the hashes of crowded keys."""
    side = lambda df, how: df if crowd is None else df.join(crowd, F.xxhash64("rule", "key") == F.col("__crowd"), how)
    of_pair, on, rule = lambda df: df, ["rule", "key"], F.col("rule")
    if len(rules) == 1:
        of_pair, on, rule = lambda df: df.drop("rule"), ["key"], F.lit(rules[0].rank)
    met = F.col("since") <= F.col("as_of")
    if any(r.between is not None for r in rules):
        met &= F.col("value").between(F.col("low"), F.col("high"))
    pairs = of_pair(side(probes, "left_anti")).join(of_pair(side(entries, "left_anti")), on).where(met).withColumn("best", best)
    hits = pairs.select("id", rule.alias("rule"), F.lit(1).cast("bigint").alias("n"), "best", F.when(F.col(other) != F.col("own"), F.col("best")).alias("best_other"))
    if crowd is None:
        return hits
    return hits.unionByName(_crowded_hits(side(probes, "left_semi"), side(entries, "left_semi"), rules, other, best, kept))


def _left(invoices: DataFrame, matched: DataFrame, rules: list[MatchRule], as_of: Column, id: str, own: str) -> DataFrame:
    """Invoices that are not matched, with the columns that some rules ask for."""
    asked = [F.col(id), F.col(own), as_of]
    for rule in rules:
        asked += [*rule.probe_keys, *(rule.between or ())[:2], *([] if rule.probe_where is None else [rule.probe_where])]
    used = invoices.select(*asked)._jdf.queryExecution().analyzed().references().toSeq()
    names = {used.apply(n).name() for n in range(used.size())}
    # merged by hint: the files of the ids, by whose size Spark would broadcast, are far smaller than the ids in memory
    ids = matched.select(F.col("id").alias("__matched")).hint("merge")
    return invoices.join(ids, F.col(id) == F.col("__matched"), "left_anti").select(*[c for c in invoices.columns if c in names])


def _crowded_hits(probes: DataFrame, entries: DataFrame, rules: list[MatchRule], other: str, best: Column,
                  kept: Callable[[DataFrame, str], DataFrame]) -> DataFrame:
    """What probes of crowded keys meet, one row per probe or piece of it, from the timelines of their keys."""
    on = ["rule", "key"]
    probes = kept(probes, "waterfall-crowded-probes")
    entries = kept(_claim_pieces(entries.join(probes.select(*on).distinct(), on, "left_semi"), rules), "waterfall-claim-pieces")
    probes = kept(_probe_pieces(probes, rules).join(entries.select(*on).distinct(), on, "left_semi"), "waterfall-probe-pieces")
    answers = accumulate(probes, entries, other, best)
    other_best = F.when(F.col("own") != F.col(f"first.{other}"), F.col("first")).otherwise(F.col("second"))
    return (probes.join(answers, [*on, "as_of"])
            .select("id", "rule", "n", "best", F.when(F.col("own").isNotNull(), other_best).alias("best_other")))


def _first_rule_of_null_ids(probes: DataFrame, entries: DataFrame, rules: list[MatchRule]) -> int | None:
    """Earliest rule matched by an invoice without id; None when there is none."""
    entries = _claim_pieces(entries.join(probes.select("rule", "key").distinct(), ["rule", "key"], "left_semi"), rules)
    nameless = _probe_pieces(probes, rules).groupBy("rule", "key").agg(F.max("as_of").alias("as_of"))
    counts = (entries.join(nameless, ["rule", "key"]).where(F.col("since") <= F.col("as_of"))
              .groupBy("rule").agg(F.count(F.lit(1)).alias("n")))
    unique = [r.rank for r in rules if r.unique]
    return counts.where(~F.col("rule").isin(unique) | (F.col("n") == 1)).agg(F.min("rule").alias("r")).first().r
