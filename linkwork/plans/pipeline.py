"""Fit and apply the whole linkage pipeline: records, blocking, features, model, decision."""

from __future__ import annotations

import json
from dataclasses import asdict, dataclass

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..config import Config
from ..operators import blocking, decision, evaluation, features, models, tfidf
from ..operators.records import normalize_records
from ..sources.tables import cut, matching_long


def candidates(s1: DataFrame, s23: DataFrame, cfg: Config, ranker: models.CheapRanker) -> DataFrame:
    """Pruned candidate pairs of normalised records, with provenance and scores.

    Each step reads its predecessor several times, so each is a written table:
    nothing is worked out twice, and a lost executor costs one step.
    """
    keys = cfg.geo_keys if cfg.geo_enabled else ()
    queries, places = blocking.geo_keys(s1, s23, keys, cfg.geo_fallback, cfg.geo_cap) if keys else (s1.select("id", F.lit("").alias("geo_key")), s23.select("id", F.lit("").alias("geo_key")))
    queries, places = cut(queries), cut(places)
    found = blocking.channels(s1, s23, queries, places, cfg)
    flags = cut(blocking.provenance(found, blocking.geo_pool(queries, places) if cfg.geo_passthrough else None))
    cheap = ranker.score(blocking.cheap_features(blocking.attach(flags.select("s1", "rid"), s1, s23)))
    ranked = cut(blocking.top_k(cheap.select("s1", "rid", "cheap_rank_score"), "s1", cfg.ranker_keep, "cheap_rank_score").join(flags, ["s1", "rid"]))
    both = cut(ranked.join(tfidf.semantic(ranked, s1, s23, cfg.semantic_k), ["s1", "rid"]))
    rank = tfidf.reciprocal(both, s1, s23, cfg.reciprocal_k)
    both = both.join(rank, ["s1", "rid"]).withColumn("is_mutual_topk", F.col("reciprocal_rank").isNotNull())
    both = both.withColumn("retrieved_reciprocal", F.col("is_mutual_topk"))
    marks = [f"retrieved_{c}" for c in blocking.CHANNELS] + [f"retrieved_semantic_{x}" for x in ("name", "address", "combined")]
    n = sum((F.col(c).cast("int") for c in marks), F.lit(0))
    both = both.withColumn("provenance_count", F.greatest(n, F.lit(1)))
    return blocking.prune(cut(both), cfg.prune_keep, cfg.prune_min_provenance)


def fit_ranker(s1: DataFrame, s23: DataFrame, labels: DataFrame, cfg: Config) -> models.CheapRanker:
    """On the whole pools of the entities that have labels; unlabelled pairs count as 0."""
    ranker = models.CheapRanker(cfg.ranker_min_positive)
    if not cfg.ranker_enabled:
        return ranker
    own = s1.join(labels.select(F.col("source1_entity_id").alias("id")).distinct(), "id", "left_semi")
    pool = blocking.geo_pool(*blocking.geo_keys(own, s23, cfg.geo_keys, cfg.geo_fallback, cfg.geo_cap))
    return ranker.fit(cut(features.attach_labels(blocking.cheap_features(blocking.attach(pool, own, s23)), labels)))


@dataclass
class Linker:
    """A fitted pipeline."""

    cfg: Config
    ranker: models.CheapRanker
    pair: models.PairModel
    calibrator: models.Calibrator
    threshold: float
    entity: models.PairModel | None = None
    entity_threshold: float = 0.5
    report: dict | None = None

    def transform(self, s1: DataFrame, s23: DataFrame) -> DataFrame:
        """Scored and decided candidate pairs (accepted 0 or 1)."""
        a, b = cut(normalize_records(s1, "source1_entity_id")), cut(normalize_records(s23, "record_id"))
        feats = cut(features.pair_features(cut(candidates(a, b, self.cfg, self.ranker)), a, b))
        scored = models.score_pairs(feats, self.pair, self.calibrator)
        if self.entity is not None:
            return self.entity.score(scored, "entity_score").withColumn("accepted", (F.col("entity_score") >= self.entity_threshold).cast("int"))
        return scored.withColumn("accepted", decision.hand_rule("pair_score", self.threshold, self.cfg.weak_gap))

    def matches(self, s1: DataFrame, s23: DataFrame) -> DataFrame:
        """The long result: accepted pairs and a NONE row for every other entity."""
        own = self.transform(s1, s23).where("accepted = 1").select(F.col("s1").alias("source1_entity_id"), F.col("source").alias("candidate_source"), F.col("rid").alias("candidate_record_id"), F.col("pair_score").alias("match_probability"))
        return matching_long(own, s1.select("source1_entity_id")).orderBy("source1_entity_id", "candidate_record_id")

    def frozen(self) -> str:
        """What was decided when fitting, as JSON."""
        return json.dumps({"calibration_method": self.calibrator.method, "threshold": self.threshold, "entity_decision_method": "learned" if self.entity else "rule", "entity_threshold": self.entity_threshold} | (self.report or {}))

    def save(self, spark: SparkSession, path: str) -> None:
        """The settings, the decision and every fitted model, in a folder that Spark can write."""
        fitted = {"ranker": self.ranker.model, "pair": self.pair.model, "calibrator": self.calibrator.model, "entity": self.entity and self.entity.model}
        for name, model in fitted.items():
            if model is not None:
                PipelineModel([model]).write().overwrite().save(f"{path}/{name}")
        meta = {
            "config": asdict(self.cfg), "pair_columns": self.pair.columns, "entity_columns": self.entity and self.entity.columns,
            "fitted": [k for k, v in fitted.items() if v is not None], "frozen": json.loads(self.frozen()), "report": self.report,
        }
        spark.createDataFrame([(json.dumps(meta),)], "value string").coalesce(1).write.mode("overwrite").text(f"{path}/linker")

    @classmethod
    def load(cls, spark: SparkSession, path: str) -> Linker:
        """What ``save`` wrote."""
        meta = json.loads(spark.read.text(f"{path}/linker").first().value)
        cfg = Config(**{k: tuple(v) if isinstance(v, list) else v for k, v in meta["config"].items()})
        model = lambda name: PipelineModel.load(f"{path}/{name}").stages[0] if name in meta["fitted"] else None
        frozen = meta["frozen"]
        ranker, cal = models.CheapRanker(cfg.ranker_min_positive), models.Calibrator(frozen["calibration_method"])
        ranker.model, cal.model = model("ranker"), model("calibrator")
        pair, entity = models.PairModel(None, meta["pair_columns"]), None
        pair.model = model("pair")
        if "entity" in meta["fitted"]:
            entity = models.PairModel(None, meta["entity_columns"])
            entity.model = model("entity")
        return cls(cfg, ranker, pair, cal, frozen["threshold"], entity, frozen["entity_threshold"], meta["report"])


def fit(s1: DataFrame, s23: DataFrame, labels: DataFrame, cfg: Config | None = None, trees: int = 200) -> Linker:
    """Train on labelled entities: ranker, grouped out-of-fold scores, hard-negative weights, calibration, decision."""
    cfg = cfg or Config()
    a, b = cut(normalize_records(s1, "source1_entity_id")), cut(normalize_records(s23, "record_id"))
    ranker = fit_ranker(a, b, labels, cfg)
    feats = cut(features.attach_labels(features.pair_features(cut(candidates(a, b, cfg, ranker)), a, b), labels))
    folds = cut(decision.make_folds(feats, "s1", cfg.n_folds))
    truth = labels.select(F.col("source1_entity_id").alias("s1"), F.col("candidate_record_id").alias("rid"), "label")
    make = lambda: models.get_pair_model(cfg.pair_model, cfg.seed, trees)
    oof = cut(models.run_oof(feats, folds, make))
    best_of = lambda d: evaluation.best_threshold(evaluation.sweep_threshold(d.select("s1", "rid", F.col("oof_score").alias("score")), truth, *cfg.sweep)).first().macro_f05
    hard = cut(decision.mine_hard_negatives(oof, cfg=cfg))
    low, high = cfg.weight_range
    best = (1.0, best_of(oof), feats.withColumn("sample_weight", F.lit(1.0)), oof)
    if not hard.isEmpty():
        for w in (low, (low + high) / 2, high):
            weighted = cut(decision.sample_weights(feats, hard, w))
            scored = cut(models.run_oof(weighted, folds, make, weight="sample_weight"))
            f = best_of(scored)
            if f > best[1]:
                best = (w, f, weighted, scored)
    weight, _, weighted, oof = best
    pair = make().fit(weighted, "sample_weight")
    if cfg.calibration == "auto":
        cal, threshold, f05 = models.choose_calibration(oof, truth, cfg.sweep)
    else:
        cal = models.Calibrator(cfg.calibration).fit(oof, "oof_score")
        row = evaluation.best_threshold(evaluation.sweep_threshold(cal.transform(oof, "oof_score", "score").select("s1", "rid", "score"), truth, *cfg.sweep)).first()
        threshold, f05 = row.threshold, row.macro_f05
    out = Linker(cfg, ranker, pair, cal, threshold, report={"oof_macro_f05_at_selection": f05, "hard_negative_weight": weight})
    prepared = cut(features.relative_features(cal.transform(oof, "oof_score", "pair_score").drop("rank", "percentile", "best_score", "candidate_count", "second_best_score", "score_gap", "fold"), "pair_score"))
    rule = evaluation.macro_f05(prepared.withColumn("ok", decision.hand_rule("pair_score", threshold, cfg.weak_gap)).where("ok = 1"), truth).first().macro_f05
    out.report["rule_macro_f05"] = rule
    pos, n_folds = prepared.agg(F.sum("label")).first()[0] or 0, folds.select("fold").distinct().count()
    if cfg.entity_model_enabled and pos >= 10 and n_folds >= 2:
        make_entity = lambda: models.entity_model(cfg.seed, min(trees, 150))
        nested = cut(models.run_oof(prepared, folds, make_entity, name="score"))
        row = evaluation.best_threshold(evaluation.sweep_threshold(nested.select("s1", "rid", "score"), truth, *cfg.sweep)).first()
        out.report["learned_macro_f05"] = row.macro_f05
        if row.macro_f05 > rule:
            out.entity, out.entity_threshold = make_entity().fit(prepared), row.threshold
    return out


def evaluate(linker: Linker, s1: DataFrame, s23: DataFrame, labels: DataFrame) -> DataFrame:
    """Metrics of the fitted pipeline on held-out entities, all of which count."""
    truth = labels.select(F.col("source1_entity_id").alias("s1"), F.col("candidate_record_id").alias("rid"), "label")
    return evaluation.macro_f05(linker.transform(s1, s23).where("accepted = 1"), truth, s1.select(F.col("source1_entity_id").alias("s1")))


def diagnostics(pairs: DataFrame, s1: DataFrame, s23: DataFrame, truth: DataFrame) -> dict[str, DataFrame]:
    """Recall ceiling, sizes, reduction and channels of candidate pairs."""
    return {
        "recall": evaluation.blocking_recall(pairs, truth),
        "sizes": evaluation.candidate_size_stats(pairs, s1.select(F.col("id").alias("s1"))),
        "reduction": evaluation.reduction_ratio(pairs, s1, s23),
        "channels": evaluation.channel_contribution(pairs, truth),
    }
