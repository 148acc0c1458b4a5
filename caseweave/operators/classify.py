"""A caller's labelling or judging function applied in batches, with one output row for each input row.

The function is created once per partition by ``make()``; it may call a model.  Batches are bounded by ``batch_size``,
and groups are never gathered: rows are dealt by a salted key, so a hot subcategory spreads over tasks.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from caseweave.operators.merge import keep_first
from caseweave.operators.validate import sized
from caseweave.sources.shared import checkpointed, scratch

GAP, NO_ID = "pipeline_gap", "no id"
#: Waves of a resumable run whose caller names no size for them.
WAVES = 32


def _calls(frame: pd.DataFrame, key: str, batch_size: int) -> list[pd.DataFrame]:
    """Batches of up to ``batch_size`` rows in which no id is repeated; rows without an id are in none."""
    known = frame[frame[key].notna()]
    if known[key].is_unique:
        return [known.iloc[k : k + batch_size] for k in range(0, len(known), batch_size)]
    turn = known.groupby(key, sort=False).cumcount()  # a row goes with those of as many earlier rows of their id
    return [part.iloc[k : k + batch_size] for _, part in known.groupby(turn, sort=True) for k in range(0, len(part), batch_size)]


def _asked(batches: list[pd.DataFrame], answers, key: str, columns: list[str]) -> tuple[pd.DataFrame, list[str]]:
    """The answers of calls, by the rows' index, and each call's reason for rows without one; unknown ids go, an id's first answer counts.

    Each batch is one call; its answers are matched with its rows together with those of all other calls.
    """
    given, reasons = [], []
    for batch, answer in zip(batches, answers, strict=True):
        try:
            out, reason = answer(batch), "no answer"
        except Exception as error:  # a failing batch is a result, not the end of the job
            out, reason = pd.DataFrame(columns=[key, *columns]), f"{type(error).__name__}: {error}"
        given.append(out if {key, *columns} <= set(out.columns) else out.reindex(columns=[key, *columns]))
        reasons.append(reason)
    calls = [n for n, out in enumerate(given) if len(out)]
    if not calls:
        return pd.DataFrame(columns=[*columns], dtype=object), reasons
    found = pd.concat([given[n][[key, *columns]].astype(object) for n in calls], ignore_index=True)
    numbers = {}  # ids by number, so that a call and an id are one whole number
    number = lambda values: [numbers.setdefault(v, len(numbers)) for v in values]
    rows = [(n, batch.index.to_numpy(), number(batch[key])) for n, batch in enumerate(batches)]
    ids = np.array([numbers.get(v, -1) for v in found[key]], np.int64)
    width = len(numbers) + 1
    call = np.repeat(calls, [len(given[n]) for n in calls])
    place = pd.Series(np.concatenate([index for _, index, _ in rows]), index=np.concatenate([np.array(k, np.int64) + n * width for n, _, k in rows]))
    code = pd.Index(np.where(ids >= 0, ids + call * width, -1))
    at = place.index.get_indexer(code)
    kept = (at >= 0) & ~code.duplicated()
    out = found.loc[kept, columns]
    out.index = place.to_numpy()[at[kept]]
    return out, reasons


def _outcomes(frame: pd.DataFrame, out: pd.DataFrame, batches: list[pd.DataFrame], why: list[str], key: str, columns: list[str]) -> pd.DataFrame:
    """One row for each row of ``frame``: its answer, or a gap with the reason."""
    rows = out.reindex(frame.index) if len(out) else pd.DataFrame(index=frame.index, columns=columns)
    hit = frame.index.isin(out.index)
    reasons = np.full(len(frame), NO_ID, dtype=object)  # the index counts rows from 0
    for batch, reason in zip(batches, why, strict=True):
        reasons[batch.index.to_numpy()] = reason
    rows.insert(0, key, frame[key])
    rows["validation_status"] = pd.Series(GAP, index=frame.index, dtype=object).where(~hit, None)
    rows["gap_reason"] = pd.Series(reasons, index=frame.index, dtype=object).where(~hit, None)
    return rows.astype(object).where(rows.notna(), None)


def classify(df: DataFrame, make, schema: str, key: str = "in_id", batch_size: int = 10) -> DataFrame:
    """``make()`` gives a function from a frame of up to ``batch_size`` rows to a frame with the id and ``schema``'s columns.

    Each input row has one output row, judged by its own content whatever the batches: a call never holds an id twice.
    Rows without an id can't be matched with an answer; they aren't asked and become gap rows (``no id``).  Ids that a
    call leaves out become gap rows (``no answer``), those of a failing call gap rows with its error.
    """
    columns = [c.split()[0] for c in schema.split(",")]
    kind = df.schema[key].dataType.simpleString()

    def run(frames):
        answer = make()
        for frame in frames:
            frame = frame.reset_index(drop=True)
            batches = _calls(frame, key, batch_size)
            out, why = _asked(batches, [answer] * len(batches), key, columns)
            yield _outcomes(frame, out, batches, why, key, columns)

    return df.mapInPandas(run, f"{key} {kind}, {schema}, validation_status string, gap_reason string")


def classify_by_subcategory(df: DataFrame, make, taxonomy: DataFrame, subcategory: str, schema: str, label: str, key: str = "in_id",
                            batch_size: int = 5, task_rows: int = 2000, tries: int = 5) -> DataFrame:
    """As ``classify``, in batches of one subcategory with its taxonomy's names; batches with invalid labels are tried again.

    After ``tries`` rounds what is still invalid stays empty.  ``taxonomy`` has ``subcategory, name``.  Rows are counted by
    subcategory first; each subcategory is dealt to as many tasks as have about ``task_rows`` of its rows.
    """
    names = taxonomy.groupBy(F.col("subcategory").alias("__sub")).agg(F.sort_array(F.collect_set("name")).alias("__names"))
    joined = df.join(sized(names), F.col(subcategory) == F.col("__sub"), "left").drop("__sub")
    counted = checkpointed(df.groupBy(F.col(subcategory).alias("__of")).agg((F.ceil(F.count(F.lit(1)) / task_rows)).alias("__salts")))
    salted = joined.join(sized(counted), F.col(subcategory).eqNullSafe(F.col("__of"))).drop("__of")
    salted = salted.withColumn("__salt", F.pmod(F.xxhash64(key), "__salts")).drop("__salts")
    tasks = max(1, counted.agg(F.sum("__salts")).first()[0] or 1)  # a stated number: by size, adaptive execution would put the few bytes into one task
    dealt = salted.repartition(int(tasks), F.col(subcategory), "__salt").sortWithinPartitions(subcategory, "__salt", key).drop("__salt")
    columns = [c.split()[0] for c in schema.split(",")]
    kind = df.schema[key].dataType.simpleString()

    def run(frames):
        answer = make()
        for frame in frames:
            frame, batches, allowed = frame.reset_index(drop=True), [], []
            names = np.empty(len(frame), dtype=object)
            for _, group in frame.groupby(subcategory, dropna=False, sort=False):
                first = group["__names"].iloc[0]
                mine = list(first) if first is not None else []
                names[group.index.to_numpy()] = [set(mine)] * len(group)
                calls = _calls(group.drop(columns="__names"), key, batch_size)
                batches += calls
                allowed += [mine] * len(calls)
            answers = [lambda b, a=a: answer(b, a) for a in allowed]
            out, why = _asked(batches, answers, key, columns)
            owner = np.full(len(frame), -1)
            for n, batch in enumerate(batches):
                owner[batch.index.to_numpy()] = n
            bad = lambda out: np.array([f and v not in names[i] for i, v, f in zip(out.index, out[label], out[label].notna(), strict=True)], bool)
            for _ in range(tries - 1):
                wrong = bad(out)
                if not wrong.any():
                    break
                rows = pd.Series(out.index[wrong]).groupby(owner[out.index[wrong]], sort=True)  # the wrong rows of a call are its next call
                again = {n: batches[n].loc[index] for n, index in rows}
                more, reasons = _asked(list(again.values()), [answers[n] for n in again], key, columns)
                for n, reason in zip(again, reasons, strict=True):
                    why[n] = reason
                out = pd.concat([out[~wrong], more]) if len(more) else out[~wrong]
            out.loc[bad(out), columns] = None
            yield _outcomes(frame, out, batches, why, key, columns)

    return dealt.mapInPandas(run, f"{key} {kind}, {schema}, validation_status string, gap_reason string")


def resumable(
    df: DataFrame, ask: Callable[[DataFrame], DataFrame], path: str, run_id: str, key: str = "in_id", failed: str = "gap_reason is not null",
    task_rows: int = 1000, wave_tasks: int | None = None, most_waves: int | None = None,
) -> DataFrame:
    """``ask(df)`` (``classify``, ``judge``, ...) by way of an append-only ledger at ``path``, one answer for each id.

    Pending rows are those whose id has no answer of this run in the ledger.  They are dealt to waves of ``wave_tasks``
    tasks of about ``task_rows`` rows; a wave's answers are appended to the ledger when it ends.  So a task that is lost asks
    again for its own ``task_rows`` rows, a job that is killed for its last wave, and a restarted job for nothing that the
    ledger has.  Without ``wave_tasks`` a wave has a task for each core, or more where there would be over ``WAVES`` waves, each
    with its jobs and files; then the last wave is one of ``WAVES`` parts of the rows.  Failed rows are given back, but not kept: the next start asks for them again.

    Of repeated ids the least row (by its columns in order) is asked; rows without an id are left out.  ``most_waves``
    ends a call early; ids that weren't asked are then missing from the result.
    """
    spark = df.sparkSession
    once = keep_first(df.where(F.col(key).isNotNull()), [key], [c for c in df.columns if c != key] or [key])
    ledger = _ledger(spark, path, run_id)
    pending = once if ledger is None else once.join(ledger.select(key), key, "left_anti")
    n = pending.count() if ledger is not None else once.count()
    tasks = wave_tasks or max(spark.sparkContext.defaultParallelism, -(-n // (task_rows * WAVES)))
    waves = max(1, -(-n // (task_rows * tasks)))
    kept, gaps = scratch(spark, "pending"), scratch(spark, "gaps")
    dealt = pending.withColumn("__wave", F.pmod(F.xxhash64(key), F.lit(waves)).cast("int"))
    dealt.repartition(F.col("__wave"), F.pmod(F.xxhash64(F.lit(1), key), F.lit(tasks))).write.partitionBy("__wave").parquet(kept)
    schema, asked = dealt.schema, 0
    for wave in range(waves if most_waves is None else min(waves, most_waves)):
        rows = spark.read.schema(schema).parquet(kept).where(F.col("__wave") == wave).drop("__wave")
        answers = checkpointed(ask(rows.repartition(tasks, key)))
        answers.where(f"not ({failed})").withColumn("run_id", F.lit(run_id)).write.mode("append").parquet(path)
        answers.where(failed).write.mode("append").parquet(gaps)
        asked += 1
    ledger = _ledger(spark, path, run_id)
    found = ledger.join(once.select(key), key, "left_semi").drop("run_id")
    return found.unionByName(spark.read.schema(found.schema).parquet(gaps)) if asked else found


def _ledger(spark, path: str, run_id: str) -> DataFrame | None:
    """The run's answers, or None if there is no ledger yet."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    if not folder.getFileSystem(spark._jsc.hadoopConfiguration()).exists(folder):
        return None
    return spark.read.parquet(path).where(F.col("run_id") == run_id)


def judge(df: DataFrame, make, schema: str, key: str = "in_id") -> DataFrame:
    """``make()`` gives a function from one row (a dict) to the values of ``schema``; a failing row becomes an error row."""
    columns = [c.split()[0] for c in schema.split(",")]
    kind = df.schema[key].dataType.simpleString()

    def run(frames):
        score = make()
        for frame in frames:
            rows = []
            for row in frame.to_dict("records"):
                try:
                    rows.append({key: row[key], **score(row), "error": None})
                except Exception as error:
                    rows.append({key: row[key], "error": f"{type(error).__name__}: {error}"})
            out = pd.DataFrame(rows, columns=[key, *columns, "error"], dtype=object)
            yield out.where(out.notna(), None)

    return df.mapInPandas(run, f"{key} {kind}, {schema}, error string")


def present_first(*columns: str):
    return F.coalesce(*(F.nullif(F.trim(F.col(c)), F.lit("")) for c in columns))


def context_l123(df: DataFrame, columns: list[str], batch: str, order: str, width: int = 150) -> DataFrame:
    """Model input: the first description that is not empty, cut, numbered within its batch."""
    number = F.row_number().over(Window.partitionBy(batch).orderBy(order))
    text = F.substring(F.coalesce(present_first(*columns), F.lit("")), 1, width)
    return df.select(order, batch, F.concat(number.cast("string"), F.lit(". "), text).alias("context"))


def context_l4(fields: list[tuple[str, str, int]], self_resolved: str | None = None):
    """Column of labelled lines ``Name: text``, each text with its own cut; empty, ``None`` and ``nan`` texts are left out."""
    from caseweave.functions.labels import trueish
    from caseweave.functions.text import present

    lines = [F.concat(F.lit(f"{name}: "), present(F.substring(F.col(c).cast("string"), 1, width))) for name, c, width in fields]
    first = [F.when(trueish(F.col(self_resolved)), "Self-resolved: yes")] if self_resolved else []
    return F.concat_ws("\n", *first, *lines)


def context_judge(parts: dict[str, list[tuple[str, str]]], total: int) -> list:
    """One column for each combined field, ``(none)`` where nothing is there, cut to a total width."""
    made = []
    for name, fields in parts.items():
        lines = [F.concat(F.lit(f"{label}: ") if label else F.lit(""), F.nullif(F.trim(F.col(c)), F.lit(""))) for label, c in fields]
        text = F.nullif(F.concat_ws("\n", *lines), F.lit(""))
        made.append(F.substring(F.coalesce(text, F.lit("(none)")), 1, total).alias(name))
    return made
