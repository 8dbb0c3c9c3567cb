"""Analytics over the log of a training run: one row a step, trends, periods, rates, as-of comparisons."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tramoggia.operators.ranking import ordered_rank
from tramoggia.operators.series import WIDTH, asof_backward, last_rows, trailing_mean
from tramoggia.session import stage


def number(value: Column) -> Column:
    """A logged number as the analyses take it: null and NaN of an entry that exists count as 0."""
    return F.coalesce(F.nanvl(value, F.lit(None).cast("double")), F.lit(0.0))


def seconds(timestamp: Column) -> Column:
    return F.unix_micros(F.to_timestamp(timestamp)) / 1e6


def entries(history: DataFrame) -> DataFrame:
    """The entries with a step other than 0, each (run, step, type) once: the last received wins."""
    fields = [F.coalesce(F.to_timestamp("timestamp"), F.lit(0).cast("timestamp")).alias("_sent"), *[F.col(c) for c in ("timestamp", "loss", "perplexity", "learning_rate", "tokens", "optimizer_step_seconds", "cpu_optimizer_active")]]
    last = history.where("global_step <> 0").groupBy("run_id", F.col("global_step").alias("step"), "type").agg(F.max(F.struct("received_at", *fields)).alias("e"))
    return last.select("run_id", "step", "type", "e.*").drop("_sent")


def pivot(history: DataFrame) -> DataFrame:
    """`pivoted` of a log as it was received."""
    return pivoted(entries(history))


def pivoted(once: DataFrame) -> DataFrame:
    """(run_id, step, train_loss, perplexity, learning_rate, eval_loss, eval_perplexity): train and eval entries of a step side by side."""
    of = lambda kind, c: F.max(F.when(F.col("type") == kind, number(F.col(c))))
    made = {"train_loss": of("train", "loss"), "perplexity": of("train", "perplexity"), "learning_rate": of("train", "learning_rate"), "eval_loss": of("eval", "loss"), "eval_perplexity": of("eval", "perplexity")}
    return once.groupBy("run_id", "step").agg(*[v.alias(k) for k, v in made.items()])


def smoothed(rows: DataFrame, window: int = 16, rate_window: int = 4) -> DataFrame:
    """Pivoted rows with trailing means of loss, perplexity and learning rate."""
    return trailing_mean(rows, "run_id", "step", {"train_loss": window, "perplexity": window, "learning_rate": rate_window})


def rate_of(rows: DataFrame, n: int, name: str) -> DataFrame:
    """(run_id, name_steps, name_seconds) between the first and last of each run's last `n` timed entries."""
    recent = last_rows(rows.where("timestamp is not null"), "run_id", "step", n, ["type"])
    ends = recent.groupBy("run_id").agg(F.max_by(F.struct("step", "timestamp"), "back").alias("a"), F.min_by(F.struct("step", "timestamp"), "back").alias("b"), F.count("*").alias("n"))
    return ends.where("n >= 2").select("run_id", (F.col("b.step") - F.col("a.step")).alias(f"{name}_steps"), (seconds(F.col("b.timestamp")) - seconds(F.col("a.timestamp"))).alias(f"{name}_seconds"))


def trends(history: DataFrame, span: int = 120) -> DataFrame:
    """Per run: recent against previous mean loss, its spread, the best step, steps a minute, the gap to evaluation, a verdict."""
    # Both are read several times: the log itself is read and made unique once.
    once = stage(entries(history), "log-entries")
    rows = stage(pivoted(once), "log-steps")
    train = rows.where("train_loss is not null")
    recent = last_rows(train, "run_id", "step", 2 * span)
    now = F.col("back") < span
    stats = recent.groupBy("run_id").agg(F.avg(F.when(now, F.col("train_loss"))).alias("recent_avg"), F.avg(F.when(~now, F.col("train_loss"))).alias("previous_avg"), F.stddev_pop(F.when(now, F.col("train_loss"))).alias("volatility"))
    best = train.groupBy("run_id").agg(F.min(F.struct("train_loss", "step")).alias("b")).select("run_id", F.col("b.train_loss").alias("best_loss"), F.col("b.step").alias("best_step"))
    speed = rate_of(once.where("type = 'train'"), 80, "timed")
    per_minute = F.when((F.col("timed_seconds") > 0) & (F.col("timed_steps") > 0), F.col("timed_steps") / F.col("timed_seconds") * 60)
    trend = F.when(F.col("previous_avg") != 0, (F.col("recent_avg") - F.col("previous_avg")) / F.col("previous_avg") * 100)
    out = stats.join(best, "run_id").join(speed, "run_id", "left").join(gaps(rows).where("latest").select("run_id", "eval_gap"), "run_id", "left")
    out = out.withColumns({"trend_pct": trend, "steps_per_minute": per_minute})
    verdict = F.when(F.col("trend_pct") < -3, "in miglioramento").when(F.col("trend_pct") > 3, "peggiora").when(F.col("trend_pct").isNotNull(), "stabile").otherwise("raccolgo dati")
    noisy = F.when(F.col("volatility") > 0.85, F.lit(" / rumoroso")).otherwise(F.lit(""))
    return out.select("run_id", "recent_avg", "previous_avg", "trend_pct", "volatility", "best_loss", "best_step", "steps_per_minute", "eval_gap", F.concat(verdict, noisy).alias("verdict"))


def gaps(rows: DataFrame) -> DataFrame:
    """(run_id, step, eval_loss, train_step, train_loss, eval_gap, latest): each evaluation with the last training row at or before it."""
    evals = rows.where("eval_loss is not null").select("run_id", "step", "eval_loss")
    trains = rows.where("train_loss is not null").select("run_id", "step", F.col("step").alias("train_step"), "train_loss")
    joined = asof_backward(evals, trains, "run_id", "step", ["train_step", "train_loss"])
    last = evals.groupBy("run_id").agg(F.max("step").alias("_last"))
    return joined.join(last, "run_id").select("run_id", "step", "eval_loss", "train_step", "train_loss", (F.col("eval_loss") - F.col("train_loss")).alias("eval_gap"), (F.col("step") == F.col("_last")).alias("latest"))


def eta(history: DataFrame, n: int = 30) -> DataFrame:
    """(run_id, current_step, total_steps, progress_pct, eta_seconds): from the rate of the last timed entries; null where it can't be told."""
    timed = entries(history)
    now = history.where("global_step <> 0").groupBy("run_id").agg(F.max("global_step").alias("current_step"), F.max("total_steps").alias("total_steps"))
    joined = now.join(rate_of(timed, n, "recent"), "run_id", "left")
    open_ = (F.col("recent_seconds") > 0) & (F.col("recent_steps") > 0) & (F.col("total_steps") > 0) & (F.col("current_step") < F.col("total_steps"))
    left = (F.col("total_steps") - F.col("current_step")) / F.col("recent_steps") * F.col("recent_seconds")
    pct = F.when(F.col("total_steps") > 0, F.least(F.lit(100.0), F.greatest(F.lit(0.0), F.col("current_step") / F.col("total_steps") * 100)))
    return joined.select("run_id", "current_step", "total_steps", pct.alias("progress_pct"), F.when(open_, left).alias("eta_seconds"))


def clamped_domain(rows: DataFrame, left: Column, right: Column) -> DataFrame:
    """(run_id, lo, hi): a step range cut to each run's steps; bounds may be swapped, a range outside gives no row."""
    extent = rows.groupBy("run_id").agg(F.min("step").alias("first"), F.max("step").alias("last"))
    cut = extent.withColumns({"lo": F.greatest("first", F.least(left, right)), "hi": F.least("last", F.greatest(left, right))})
    return cut.where("lo <= hi").select("run_id", "lo", "hi")


def periods(history: DataFrame, left: int | None = None, right: int | None = None) -> DataFrame:
    """Per run, over a range of steps (all by default): ends, change, straight trend, extremes, spread, rates, behaviour."""
    bounds = [b for b in (left, right) if b is not None]
    inside = F.col("step").between(min(bounds), max(bounds)) if len(bounds) == 2 else F.col("step") >= left if left is not None else F.col("step") <= right if right is not None else F.lit(True)
    once = stage(entries(history).where(inside), "log-entries")
    rows = stage(pivoted(once), "log-steps")
    train = rows.where("train_loss is not null")
    point = F.struct("step", "train_loss", "learning_rate")
    stats = train.groupBy("run_id").agg(
        F.min(point).alias("a"), F.max(point).alias("b"), F.count("*").alias("points"), F.avg("train_loss").alias("avg_loss"), F.stddev_pop("train_loss").alias("volatility"),
        F.min(F.struct("train_loss", "step")).alias("best"), F.max(F.struct(F.col("train_loss"), (-F.col("step")).alias("back"))).alias("worst"),
        F.regr_slope("train_loss", "step").alias("slope"), F.avg("perplexity").alias("avg_perplexity"),
    )
    raw = once.where("type = 'train'")
    timed = F.when(F.col("timestamp").isNotNull(), F.struct("step", "timestamp"))
    work = raw.groupBy("run_id").agg(F.min(timed).alias("t0"), F.max(timed).alias("t1"), F.sum("tokens").alias("tokens_total"), F.avg("tokens").alias("tokens_avg"), (F.avg(F.coalesce("cpu_optimizer_active", F.lit(False)).cast("double")) * 100).alias("cpu_optimizer_share"))
    evals = gaps(rows).groupBy("run_id").agg(F.count("*").alias("eval_count"), F.max(F.when(F.col("latest"), F.col("eval_gap"))).alias("eval_gap"))
    out = stats.join(work, "run_id", "left").join(evals, "run_id", "left")
    first, last = F.col("a.train_loss"), F.col("b.train_loss")
    duration = seconds(F.col("t1.timestamp")) - seconds(F.col("t0.timestamp"))
    run = F.col("t1.step") - F.col("t0.step")
    projected = F.when(first != 0, F.col("slope") * (F.col("b.step") - F.col("a.step")) / first * 100)
    delta_pct = F.when(first != 0, (last - first) / first * 100)
    out = out.select(
        "run_id", F.col("a.step").alias("start_step"), F.col("b.step").alias("end_step"), "points", first.alias("first_loss"), last.alias("last_loss"), (last - first).alias("delta_loss"), delta_pct.alias("delta_pct"),
        projected.alias("trend_pct"), "avg_loss", "volatility", F.col("best.train_loss").alias("best_loss"), F.col("best.step").alias("best_step"), F.col("worst.train_loss").alias("worst_loss"), (-F.col("worst.back")).alias("worst_step"),
        "avg_perplexity", F.col("a.learning_rate").alias("lr_start"), F.col("b.learning_rate").alias("lr_end"), F.when(run != 0, duration).alias("duration_seconds"),
        F.when((duration > 0) & (run > 0), run / duration * 60).alias("steps_per_minute"), "tokens_avg", "tokens_total", F.coalesce("eval_count", F.lit(0)).alias("eval_count"), "eval_gap", "cpu_optimizer_share",
    )
    movement = F.coalesce("trend_pct", "delta_pct")
    behaviour = F.when(movement < -5, "migliora netto").when(movement < -1, "migliora leggero").when(movement > 5, "peggiora netto").when(movement > 1, "peggiora leggero").otherwise("stabile")
    unstable = F.when((F.col("avg_loss") != 0) & (F.col("volatility") / F.col("avg_loss") > 0.12), F.lit(" / instabile")).otherwise(F.lit(""))
    return out.withColumn("behavior", F.concat(behaviour, unstable))


def epochs(history: DataFrame) -> DataFrame:
    """(run_id, epoch, type, entries, mean_loss, perplexity): finite losses of each epoch, perplexity from the mean capped at 20."""
    once = history.where("global_step <> 0").groupBy("run_id", "global_step", "type", "epoch").agg(F.max(F.struct("received_at", "loss")).alias("e"))
    finite = F.nanvl(F.col("e.loss"), F.lit(None).cast("double"))
    out = once.groupBy("run_id", "epoch", "type").agg(F.count("*").alias("entries"), F.avg(finite).alias("mean_loss"))
    return out.withColumn("perplexity", F.exp(F.least("mean_loss", F.lit(20.0))))


def slow_steps(history: DataFrame, limit: float = 60.0) -> DataFrame:
    """Training entries whose optimiser step took `limit` seconds or more."""
    return entries(history).where((F.col("type") == "train") & (F.nanvl("optimizer_step_seconds", F.lit(0.0)) >= limit)).select("run_id", "step", "optimizer_step_seconds")


def latest(history: DataFrame) -> DataFrame:
    """(run_id, step, type, loss, timestamp): each run's entry received last; of those received together the one of the highest step, then type."""
    last = F.max(F.struct(F.coalesce("received_at", F.lit(0).cast("timestamp")), F.coalesce("global_step", F.lit(-1)), F.coalesce("type", F.lit("")), "loss", "timestamp")).alias("e")
    return history.groupBy("run_id").agg(last).select("run_id", F.col("e.col2").alias("step"), F.col("e.col3").alias("type"), "e.loss", "e.timestamp")


def visible(rows: DataFrame, left: Column, right: Column) -> DataFrame:
    """Smoothed pivoted rows within a range of steps, cut to each run's own: means reach back beyond the range; a range outside shows the whole run."""
    made = smoothed(rows)
    joined = made.join(clamped_domain(rows, left, right), "run_id", "left")
    return joined.where("lo is null or step between lo and hi").drop("lo", "hi")


def period_domain(rows: DataFrame, selected: tuple[int, int] | None, zoom: tuple[int, int] | None) -> DataFrame:
    """(run_id, mode, lo, hi): the steps a period analysis takes: of the selection if it meets the run, else of the zoom, else the whole run."""
    extent = rows.groupBy("run_id").agg(F.min("step").alias("first"), F.max("step").alias("last"))
    mode, lo, hi = F.lit("run completo"), F.col("first"), F.col("last")
    for name, pair in (("zoom visibile", zoom), ("selezione", selected)):
        if pair is not None:
            a, b = F.greatest("first", F.lit(min(pair))), F.least("last", F.lit(max(pair)))
            mode, lo, hi = F.when(a <= b, name).otherwise(mode), F.when(a <= b, a).otherwise(lo), F.when(a <= b, b).otherwise(hi)
    return extent.select("run_id", mode.alias("mode"), lo.cast("bigint").alias("lo"), hi.cast("bigint").alias("hi"))


def rates(history: DataFrame) -> DataFrame:
    """(run_id, step, perplexity, tokens_per_second, steps_per_second, eta_seconds) of every training entry.

    Tokens and seconds are those since the entry before, steps those since the run's first one. `tokens` of the log is
    a running total. Runs are cut into ranges of steps, so that a long one isn't one task's work.
    """
    totals = history.where("global_step <> 0").groupBy("run_id").agg(F.max("total_steps").alias("total_steps"))
    once = stage(entries(history).where("type = 'train'").select("run_id", "step", "loss", "tokens", seconds(F.col("timestamp")).alias("at")), "log-entries")
    ranked = stage(ordered_rank(once, ["run_id"], "step", WIDTH, "_rn"), "log-ranks")
    before = ranked.select("run_id", (F.col("_rn") + 1).alias("_rn"), F.col("tokens").alias("_tokens"), F.col("at").alias("_at"))
    first = ranked.where("_rn = 0").select("run_id", F.col("step").alias("_step0"), F.col("at").alias("_at0"))
    joined = ranked.join(before, ["run_id", "_rn"], "left").join(first.join(totals, "run_id"), "run_id")
    pace = F.when(F.col("at") > F.col("_at0"), (F.col("step") - F.col("_step0")) / (F.col("at") - F.col("_at0")))
    spent = F.greatest(F.col("at") - F.col("_at"), F.lit(1e-6))
    left = F.when(pace > 0, (F.col("total_steps") - F.col("step")) / pace)
    return joined.select(
        "run_id", "step", F.exp(F.least(number(F.col("loss")), F.lit(20.0))).alias("perplexity"), ((F.col("tokens") - F.col("_tokens")) / spent).alias("tokens_per_second"), pace.alias("steps_per_second"), left.alias("eta_seconds")
    )


def evaluation(history: DataFrame) -> DataFrame:
    """(run_id, batches, mean_loss, perplexity): the mean of a run's evaluation losses that are numbers, and its exponential."""
    finite = F.nanvl(F.col("loss"), F.lit(None).cast("double"))
    made = entries(history).where("type = 'eval'").groupBy("run_id").agg(F.count(finite).alias("batches"), F.avg(finite).alias("mean_loss"))
    return made.withColumn("perplexity", F.exp("mean_loss"))
