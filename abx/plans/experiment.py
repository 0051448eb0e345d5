"""The experiment DAG over one data folder: every stage a lazy DataFrame.

Stages reference each other as plain Python attributes, so the whole chain from the ``events``
scan to a report is one Catalyst plan; nothing is collected, counted or written in between.
Callers trigger exactly one action per output.
"""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import DataFrame, SparkSession

from abx.config import DEFAULT, ExperimentConfig
from abx.operators import assign, cohort, exposure, outcomes, quality, results, stage
from abx.session import cut_lineage
from abx.sources import lens as lens_mod


class ExperimentDAG:
    """Lazy stages over one data folder.

    ``checkpoint_stages=True`` cuts the lineage after the shared base stages (canonical
    assignments, validations, cohort, conversions) with a reliable checkpoint into the cluster's
    ``spark.checkpoint.dir``: many reports built from one DAG then reuse those stages instead of
    recomputing them from ``events``, and a lost executor recomputes from the checkpoint only.
    """

    def __init__(
        self,
        spark: SparkSession,
        sf_dir: str,
        cfg: ExperimentConfig = DEFAULT,
        checkpoint_stages: bool = False,
        as_of: str | None = None,
    ):
        self.spark = spark
        self.sf_dir = sf_dir
        self.cfg = cfg
        self.checkpoint_stages = checkpoint_stages
        # Last day (YYYY-MM-DD) whose events are seen; all if not given.
        self.as_of = as_of

    def at(self, dt: str) -> ExperimentDAG:
        """The same stages over the events up to the end of day ``dt``, the shared ones checkpointed: a
        report folds many guards over them, and each is built once."""
        return ExperimentDAG(self.spark, self.sf_dir, self.cfg, checkpoint_stages=True, as_of=dt)

    def once(self) -> ExperimentDAG:
        """The same stages with the shared ones checkpointed, for queries that read many of them."""
        return ExperimentDAG(self.spark, self.sf_dir, self.cfg, checkpoint_stages=True, as_of=self.as_of)

    def _cut(self, df: DataFrame) -> DataFrame:
        return cut_lineage(df) if self.checkpoint_stages else df

    # ---- sources -------------------------------------------------------------------------
    @cached_property
    def events(self) -> DataFrame:
        from pyspark.sql import functions as F

        ev = lens_mod.load_events(self.spark, self.sf_dir)
        if self.as_of is None:
            return ev
        end = F.lit(self.as_of).cast("timestamp_ntz") + F.make_dt_interval(days=F.lit(1))
        return ev.filter(F.col("ts") < end)

    @cached_property
    def raw_assignments(self) -> DataFrame:
        return lens_mod.raw_assignments(self.events)

    @cached_property
    def raw_exposures(self) -> DataFrame:
        return lens_mod.raw_exposures(self.events)

    @cached_property
    def event_feed(self) -> DataFrame:
        return lens_mod.event_feed(self.events)

    @cached_property
    def dim_experiment(self) -> DataFrame:
        return lens_mod.dim_experiment(self.events)

    @cached_property
    def dim_variant(self) -> DataFrame:
        return lens_mod.dim_variant(self.events)

    # ---- assignments ---------------------------------------------------------------------
    @cached_property
    def canonical(self) -> DataFrame:
        return self._cut(assign.canonical_assignments(self.raw_assignments))

    # ---- exposures -----------------------------------------------------------------------
    @cached_property
    def staged(self) -> DataFrame:
        return stage.stage_exposures(self.event_feed, self.cfg)

    @cached_property
    def conversions(self) -> DataFrame:
        return self._cut(stage.stage_conversions(self.event_feed, self.cfg))

    @cached_property
    def deduped(self) -> DataFrame:
        return self._cut(exposure.dedupe_exposures(self.staged))

    @cached_property
    def validation(self) -> DataFrame:
        return self._cut(exposure.validate_exposures(self.canonical, self.deduped, self.cfg, mode="first_post"))

    @cached_property
    def staged_strict(self) -> DataFrame:
        return stage.stage_exposures_strict(self.raw_exposures)

    @cached_property
    def deduped_strict(self) -> DataFrame:
        return exposure.dedupe_exposures_strict(self.staged_strict)

    @cached_property
    def validation_any(self) -> DataFrame:
        return self._cut(exposure.validate_exposures_any(self.canonical, self.deduped_strict, self.cfg))

    # ---- quality -------------------------------------------------------------------------
    @cached_property
    def quality_daily(self) -> DataFrame:
        return quality.quality_daily(self.validation_any)

    @cached_property
    def quality_daily_post(self) -> DataFrame:
        return quality.quality_daily_post(self.validation)

    # ---- cohorts and outcomes ------------------------------------------------------------
    @cached_property
    def cohort(self) -> DataFrame:
        return self._cut(cohort.cohort(self.validation))

    @cached_property
    def outcomes_exposed(self) -> DataFrame:
        return self._cut(
            outcomes.conversion_outcomes(
                self.cohort, self.conversions, self.cfg, "exposure", prefilter=self.checkpoint_stages
            )
        )

    @cached_property
    def outcomes_itt(self) -> DataFrame:
        return outcomes.conversion_outcomes(
            self.cohort, self.conversions, self.cfg, "assignment", prefilter=self.checkpoint_stages
        )

    @cached_property
    def outcomes_from_start(self) -> DataFrame:
        """Outcomes from the assignment on, with the analysis start: the first exposure, else the assignment. A unit
        that converts before it is exposed breaks their order."""
        from pyspark.sql import functions as F

        itt = outcomes.conversion_outcomes(
            self.cohort, self.conversions, self.cfg, "assignment", ("first_exposure_at",), prefilter=self.checkpoint_stages
        )
        return itt.withColumn("analysis_start_at", F.coalesce("first_exposure_at", "anchor_at"))

    @cached_property
    def outcomes_of_raw(self) -> DataFrame:
        """Outcomes of every raw assignment, as a job without canonical assignments writes them: a unit assigned again
        has a row each time."""
        from pyspark.sql import functions as F

        rows = self.raw_assignments.select(
            "experiment_id", "unit_id", "variant_id", F.col("assigned_at").alias("anchor_at")
        ).distinct()
        key = ("experiment_id", "unit_id", "variant_id", "anchor_at")
        n = int(self.cfg.conversion_window_days)
        return outcomes.window_outcomes(rows, self.conversions, 0, n, self.cfg, key=key)

    @cached_property
    def unit_outcomes(self) -> DataFrame:
        return outcomes.unit_outcomes(
            self.cohort, self.conversions, self.cfg, prefilter=self.checkpoint_stages
        )

    # ---- results -------------------------------------------------------------------------
    @cached_property
    def metric_by_variant(self) -> DataFrame:
        return self._cut(results.metric_by_variant(self.outcomes_exposed))

    @cached_property
    def results(self) -> DataFrame:
        return self._cut(results.results(self.metric_by_variant, self.cfg))

    @cached_property
    def metric_by_variant_rounded(self) -> DataFrame:
        return results.metric_by_variant_rounded(self.outcomes_itt)

    @cached_property
    def results_pairwise(self) -> DataFrame:
        return results.results_pairwise(self.metric_by_variant_rounded, self.cfg)

    @cached_property
    def governed_results(self) -> DataFrame:
        return results.governed_results(self.results_pairwise)

    # ---- guardrails (tier B) ---------------------------------------------------------------
    def guards(self) -> dict[str, DataFrame]:
        from abx.operators import guardrails as G

        return {
            "assignment_unique": G.guard_assignment_unique(self.raw_assignments),
            "srm": G.guard_srm(self.canonical, self.dim_variant, self.cfg),
            "exposure_order": G.guard_exposure_order(self.validation),
            "outcome_order": G.guard_outcome_order(self.outcomes_from_start),
            "outcome_grain": G.guard_outcome_grain(self.outcomes_of_raw),
            "min_sample": G.guard_min_sample(self.canonical, self.dim_variant, self.cfg),
        }

    # Results of the validly exposed units alone, and the same guards over what they are built on.
    @cached_property
    def valid_cohort(self) -> DataFrame:
        return self.cohort.filter("is_in_valid_exposure_cohort AND validation_status = 'valid'")

    @cached_property
    def outcomes_valid(self) -> DataFrame:
        return outcomes.conversion_outcomes(
            self.valid_cohort, self.conversions, self.cfg, "exposure", prefilter=self.checkpoint_stages
        )

    @cached_property
    def results_valid(self) -> DataFrame:
        return results.results(results.metric_by_variant(self.outcomes_valid), self.cfg)

    def guards_valid(self) -> dict[str, DataFrame]:
        from pyspark.sql import functions as F

        from abx.operators import guardrails as G

        units = self.valid_cohort.select("experiment_id", "unit_id", F.col("assigned_variant_id").alias("variant_id"))
        first = self.validation.filter("validation_status = 'valid'")
        every = outcomes.unit_outcomes(self.valid_cohort, self.conversions, self.cfg, prefilter=self.checkpoint_stages)
        return {
            "assignment_unique": G.guard_assignment_unique(units),
            "srm": G.guard_srm(units, self.dim_variant, self.cfg),
            "exposure_order": G.guard_exposure_order(first),
            "outcome_order": G.guard_outcome_order(self.outcomes_valid, "anchor_at"),
            "outcome_grain": G.guard_outcome_grain(every),
            "min_sample": G.guard_min_sample(units, self.dim_variant, self.cfg),
        }

    def quality_report(self, dt: str, valid_only: bool = False, blocking: tuple[str, ...] | None = None) -> DataFrame:
        """One row per experiment from the guards over what was known by the end of day ``dt``; ``blocking``
        names those that stop an experiment (all if not given)."""
        from abx.operators import guardrails as G

        if self.as_of != dt:
            return self.at(dt).quality_report(dt, valid_only, blocking)
        g = self.guards_valid() if valid_only else self.guards()
        return G.experiment_quality_report(
            self.dim_experiment,
            g["assignment_unique"],
            g["srm"],
            g["exposure_order"],
            g["outcome_order"],
            g["outcome_grain"],
            g["min_sample"],
            dt,
            G.GUARDS if blocking is None else blocking,
        )

    # ---- extensions --------------------------------------------------------------------------
    @cached_property
    def cuped_units(self) -> DataFrame:
        from pyspark.sql import functions as F

        n = int(self.cfg.conversion_window_days)
        anchors = self.cohort.select(
            "experiment_id",
            "unit_id",
            F.col("assigned_variant_id").alias("variant_id"),
            F.col("assigned_at").alias("anchor_at"),
        )
        return outcomes.window_outcomes(
            anchors, self.conversions, 0, n, self.cfg, pre_days=n, prefilter=self.checkpoint_stages
        )

    @cached_property
    def itt_anchors(self) -> DataFrame:
        """(experiment_id, unit_id, variant_id, anchor_at): every canonical assignment from its time on."""
        from pyspark.sql import functions as F

        return self.canonical.select("experiment_id", "unit_id", "variant_id", F.col("assigned_at").alias("anchor_at"))

    @cached_property
    def times_to_event(self) -> DataFrame:
        """Steps from assignment to the first conversion, censored at the last event seen."""
        from pyspark.sql import functions as F

        from abx.operators import survival

        until = self.events.select(F.max("ts")).scalar()
        return survival.time_to_event(self.itt_anchors, self.conversions, until)

    @cached_property
    def sessions(self) -> DataFrame:
        from abx.operators import sessions

        types = ("view", "click", "purchase")
        return sessions.sessions(self.events, unit="user_id", at="ts", type_col="event_type", types=types)

    @cached_property
    def stitched_ids(self) -> DataFrame:
        from abx.operators import identity

        units = self.events.selectExpr("CAST(user_id AS STRING) AS unit_id")
        return identity.stitched_ids(units, lens_mod.identity_links(self.events), max_units=lens_mod.MAX_DEVICE_UNITS)

    @cached_property
    def query_log(self) -> DataFrame:
        """Logged texts to audit: every conversation turn, id = conv_id:turn (whole texts)."""
        from pyspark.sql import functions as F

        conv = self.spark.read.parquet(f"{self.sf_dir.rstrip('/')}/conversations.parquet")
        return conv.select(
            F.concat_ws(":", F.col("conv_id").cast("string"), F.col("turn").cast("string")).alias("query_id"),
            F.col("text").alias("sql_text"),
        )
