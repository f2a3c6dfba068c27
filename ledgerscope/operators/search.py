"""Guided hyper-parameter search (M5).

The first trials are drawn at random. After them, finished trials are split into the better
and the worse ones; each side gives a density for every parameter (Gaussian kernels around
its trials' values and a flat part, on the unit interval after the logarithm where the range
says so), candidates are drawn from the better side's density, and the one with the greatest
ratio of better to worse density is tried next. Trials run side by side, each a distributed
fit of its own; no trial starts after the time budget, and running fits stop growing trees.
"""

from __future__ import annotations

import json
import math
import threading
import time
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field

import numpy as np
from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerscope.operators.models import SEARCH_SPACE, SEED, train_booster, tree_probability
from ledgerscope.schema import TARGET
from ledgerscope.session import stored

TRIALS, SECONDS = 50, 300.0       # of the original search
STARTUP, CANDIDATES, BETTER = 10, 24, 0.25


@dataclass
class DensityRatioSampler:
    """Proposes parameters of ``space`` {name: (low, high, log)}; integers where both ends are."""
    space: dict[str, tuple[float, float, bool]]
    seed: int = SEED
    startup: int = STARTUP
    trials: list[tuple[np.ndarray, float]] = field(default_factory=list)

    def __post_init__(self):
        self.rng, self.lock = np.random.default_rng(self.seed), threading.Lock()

    def unit(self, params: dict) -> np.ndarray:
        out = []
        for k, (lo, hi, log) in self.space.items():
            a, b, x = (math.log(lo), math.log(hi), math.log(params[k])) if log else (lo, hi, params[k])
            out.append((x - a) / (b - a))
        return np.array(out)

    def params(self, u: np.ndarray) -> dict:
        out = {}
        for x, (k, (lo, hi, log)) in zip(u.tolist(), self.space.items(), strict=True):
            v = math.exp(math.log(lo) + x * (math.log(hi) - math.log(lo))) if log else lo + x * (hi - lo)
            out[k] = int(min(hi, max(lo, round(v)))) if isinstance(lo, int) and isinstance(hi, int) and not log else min(hi, max(lo, v))
        return out

    @staticmethod
    def density(at: np.ndarray, centres: np.ndarray) -> np.ndarray:
        """Sum of log densities over the parameters, for each row of ``at``."""
        width = max(0.05, 1.06 * len(centres) ** -0.2 * 0.3)
        k = np.exp(-0.5 * ((at[:, None, :] - centres[None]) / width) ** 2) / (width * math.sqrt(2 * math.pi))
        return np.log((k.sum(1) + 1.0) / (len(centres) + 1.0)).sum(1)        # one part is flat

    def propose(self) -> dict:
        with self.lock:
            d = len(self.space)
            if len(self.trials) < self.startup:
                return self.params(self.rng.random(d))
            order = sorted(self.trials, key=lambda t: -t[1])
            n = max(2, math.ceil(BETTER * len(order)))
            good, bad = (np.array([t[0] for t in part]) for part in (order[:n], order[n:]))
            pick = good[self.rng.integers(len(good), size=(CANDIDATES, d)), np.arange(d)]
            draw = np.clip(pick + self.rng.normal(0, 0.15, pick.shape), 0, 1)
            flat = self.rng.random(draw.shape) < 1.0 / (len(good) + 1)
            draw = np.where(flat, self.rng.random(draw.shape), draw)
            score = self.density(draw, good) - (self.density(draw, bad) if len(bad) else 0.0)
            return self.params(draw[int(score.argmax())])

    def finished(self, params: dict, value: float) -> None:
        with self.lock:
            self.trials.append((self.unit(params), value))


def maximise(objective: Callable[[dict, Callable[[], bool]], float | None], space: dict, trials: int = TRIALS,
             seconds: float = SECONDS, parallel: int = 4, seed: int = SEED) -> list[tuple[int, dict, float | None]]:
    """(trial, parameters, value) of all trials that ran. ``objective(params, out_of_time)`` may
    return None, and should end soon once ``out_of_time()`` is true."""
    sampler, end, done = DensityRatioSampler(space, seed), time.monotonic() + seconds, []

    def late() -> bool:
        return time.monotonic() >= end

    def one(t: int) -> None:
        if late() and t:                     # the first trial always runs
            return
        params = sampler.propose()
        value = objective(params, late)
        if value is not None:
            sampler.finished(params, value)
        done.append((t, params, value))
    with ThreadPoolExecutor(parallel) as pool:
        spark = SparkSession.getActiveSession()
        list(pool.map(inheritable_thread_target(spark)(one) if spark else one, range(trials)))
    return sorted(done, key=lambda x: x[0])


@dataclass
class SearchResult:
    best_params: dict
    best_value: float
    trials: DataFrame                        # trial, params (JSON), roc_auc


def search_booster(train: DataFrame, val: DataFrame, features: list[str], label: str = TARGET, trials: int = TRIALS,
                   seconds: float = SECONDS, parallel: int = 4, seed: int = SEED, space: dict | None = None) -> SearchResult:
    """Search the original eight ranges for the greatest exact validation ROC-AUC."""
    from ledgerscope.operators.metrics import roc_auc
    spark = train.sparkSession
    train, val = stored(train.select(*features, label), "search-train"), stored(val.select(*features, label), "search-val")

    def objective(params: dict, late: Callable[[], bool]) -> float | None:
        model = train_booster(train, features, label, params, stop=lambda n: n > 0 and late())
        p = tree_probability(model.ensemble, val, features).select(F.col(label).alias("y"), F.col("p_raw").alias("p"))
        return roc_auc(p).first()["roc_auc"]
    ran = maximise(objective, space or SEARCH_SPACE, trials, seconds, parallel, seed)
    scored = [r for r in ran if r[2] is not None]
    if not scored:
        raise ValueError("no trial has a value: the validation rows need both labels")
    best = max(scored, key=lambda r: (r[2], -r[0]))
    table = spark.createDataFrame([(t, json.dumps(p, sort_keys=True), v) for t, p, v in ran], "trial int, params string, roc_auc double")
    return SearchResult(best[1], best[2], table)
