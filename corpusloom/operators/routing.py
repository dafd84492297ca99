"""Which site form a URL belongs to, per stage."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from corpusloom import fixed_values as fv


def route(url: Column, domains: Sequence[str], default: str = "default") -> Column:
    """The first domain of the list that occurs anywhere in the URL."""
    return F.coalesce(
        *[F.when(F.contains(url, F.lit(d)), F.lit(d)) for d in domains], F.lit(default)
    )


def with_routes(df: DataFrame, url: str = "url", stages=fv.STAGE_ORDER) -> DataFrame:
    """One `<stage>_route` column per stage; rules are literals, so nothing is joined."""
    return df.withColumns(
        {f"{stage}_route": route(F.col(url), order) for stage, order in stages.items()}
    )


def route_by_rules(urls: DataFrame, rules: Sequence[tuple[str, int, str, str]]) -> DataFrame:
    """First match of rules (stage, priority, domain, strategy); equal priorities go by domain.

    Rules are options of the caller and become literal branches: the urls are neither shuffled nor paired.
    """
    routed = urls
    for stage in sorted({rule[0] for rule in rules}):
        ordered = sorted(rule[1:] for rule in rules if rule[0] == stage)
        branches = [F.when(F.contains(F.col("url"), F.lit(d)), F.lit(strategy)) for _, d, strategy in ordered]
        routed = routed.withColumn(f"{stage}_strategy", F.coalesce(*branches, F.lit("default")))
    return routed


def _automaton(words: dict[str, list[tuple[int, int]]], key: str):
    """The automaton of a rule table; a worker keeps the one it built last."""
    if _built.get("key") != key:
        from ahocorasick import Automaton

        made = Automaton()
        for word, entries in words.items():
            made.add_word(word, entries)
        made.make_automaton()
        _built.update(key=key, automaton=made)
    return _built["automaton"]


_built: dict = {}


def route_by_rule_table(urls: DataFrame, rules: DataFrame, most_rules: int = 1_000_000, url: str = "url") -> DataFrame:
    """`urls` with a `<stage>_strategy` for each stage of rules(stage, priority, domain, strategy), as by `route_by_rules`.

    For tables of many rules: all domains are looked for in one pass over a URL by an automaton that each worker builds once, so the
    cost grows with the length of the URL and its matches, not with the rules, and URLs are neither shuffled nor paired. The
    table goes to every worker, so it may hold at most `most_rules`; more are an error. Rules without a stage or a domain are no
    rules; an empty domain occurs in every URL. A NULL URL and one without a match go by `default`.
    """
    spark = urls.sparkSession
    known = rules.select("stage", "priority", "domain", "strategy").where("stage IS NOT NULL AND domain IS NOT NULL")
    found = known.distinct().limit(most_rules + 1).collect()
    if len(found) > most_rules:
        raise ValueError(f"more than {most_rules} rules")
    ordered = sorted((r.stage, r.priority is not None, r.priority or 0, r.domain, r.strategy or "", r.strategy) for r in found)
    stages = sorted({r[0] for r in ordered})
    words: dict[str, list[tuple[int, int]]] = {}
    for rank, rule in enumerate(ordered):
        words.setdefault(rule[3], []).append((stages.index(rule[0]), rank))
    everywhere = words.pop("", [])
    strategies = [rule[5] for rule in ordered]
    shared = spark.sparkContext.broadcast((words, strategies))
    key = str(hash(tuple(ordered)))
    schema = StructType([*urls.schema.fields, *[StructField(f"{stage}_strategy", StringType()) for stage in stages]])
    at, n_stages = urls.columns.index(url), len(stages)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, strategies = shared.value
        automaton = _automaton(words, key) if words else None
        last = len(strategies)
        for batch in batches:
            columns: list[list[str | None]] = [[] for _ in range(n_stages)]
            for address in batch.column(at).to_pylist():
                best = [last] * n_stages
                if address is not None:
                    for stage, rank in everywhere:
                        best[stage] = min(best[stage], rank)
                    for _, entries in automaton.iter(address) if automaton else ():
                        for stage, rank in entries:
                            if rank < best[stage]:
                                best[stage] = rank
                for column, rank in zip(columns, best):
                    column.append("default" if rank == last else strategies[rank])
            added = [pa.array(column, pa.string()) for column in columns]
            yield pa.RecordBatch.from_arrays([*batch.columns, *added], names=schema.fieldNames())

    return urls.mapInArrow(run, schema) if stages else urls
