"""The three products run end to end, each through the product runner:
engagement events (raw -> bronze -> silver), partner dashboard (silver ->
gold, merged on partner-day) and user journey (silver -> gold, merged on
user-partner-day).  Each product gates its own write; the downstream
products read the written silver table, as they would in production."""

from __future__ import annotations

import copy
from dataclasses import asdict, dataclass

from pyspark.sql import DataFrame, SparkSession

from lakeward import products
from lakeward.functions.expressions import Vocabulary
from lakeward.model import Product, load_product
from lakeward.plans.runner import RunResult, read_source, run_product


@dataclass
class FlowResult:
    engagement: RunResult
    dashboard: RunResult
    journey: RunResult


def flow_products(vocab: Vocabulary, on_failure: str | None = None) -> tuple[Product, Product, Product]:
    """The three contracts as declared, with ``vocab`` for the event semantics of their function steps.
    ``on_failure`` overrides the products' gate policy (None keeps them)."""
    specs = [copy.deepcopy(s) for s in products.ALL.values()]
    for spec in specs:
        for step in spec["transformations"]:
            if "vocabulary" in step:
                step["vocabulary"] = asdict(vocab)
        if on_failure:
            spec["quality"]["on_failure"] = on_failure
    return tuple(load_product(s) for s in specs)


def run_flow(spark: SparkSession, raw: DataFrame, root: str, salt: str, as_of: str, vocab: Vocabulary,
             refs: dict | None = None, on_failure: str | None = None) -> FlowResult:
    eng, dash, jour = flow_products(vocab, on_failure)
    r1 = run_product(spark, eng, raw, root, salt, "ingest_timestamp", "silver", refs)
    r2, r3 = (run_product(spark, p, read_source(spark, p, root, [eng]), root, salt, as_of, "gold", refs) for p in (dash, jour))
    return FlowResult(r1, r2, r3)
