"""Inference behind providers: what a model does is a function of a batch; stubs are deterministic.

A provider is named in REGISTRY with the schema that it adds. infer() loads it once for each Python worker. Units
that share an input are inferred once (once_per).
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


@dataclass(frozen=True)
class Provider:
    """load() returns a function from a list of inputs to a list of results; many: a result is a list of rows."""

    schema: str
    load: Callable[[], Callable[[list], list]]
    many: bool = False


def _seed(x: object) -> np.random.RandomState:
    return np.random.RandomState(int.from_bytes(hashlib.sha256(repr(x).encode()).digest()[:4], "big"))


def _unit(r: np.random.RandomState, n: int) -> list[float]:
    v = r.normal(size=n)
    return (v / np.linalg.norm(v)).astype(np.float32).tolist()


def _each(f: Callable) -> Callable[[], Callable[[list], list]]:
    return lambda: lambda xs: [f(x) for x in xs]


def _boxes(x: object) -> list[tuple]:
    r = _seed(("boxes", x))
    return [(*sorted(r.randint(0, 1920, 2).tolist()), *sorted(r.randint(0, 1080, 2).tolist()), float(round(r.uniform(0.25, 1), 4))) for _ in range(r.randint(0, 4))]


def _answer(x: object) -> str:
    return '{"boundaries": [' + ", ".join(map(str, sorted(_seed(("llm", x)).choice(np.arange(1, 60), 4, replace=False).tolist()))) + "]}"


#: Stubs: X1 embedder, X2 face presence, X3 face detector, X4 person detector, X5 diariser, X6 ASR, X7 VLM, X8 and S15 LLM, S3 and S5 decoder.
REGISTRY: dict[str, Provider] = {
    "embed": Provider("embedding array<float>", _each(lambda x: (_unit(_seed(("embed", x)), 64),))),
    "face_present": Provider("has_face boolean", _each(lambda x: (bool(_seed(("face", x)).uniform() > 0.5),))),
    "faces": Provider("det_score double, face_emb array<float>", _each(lambda x: [(float(round(r.uniform(), 4)), _unit(r, 16)) for r in [_seed(("faces", x))] for _ in range(r.randint(0, 3))]), many=True),
    "bodies": Provider("x1 int, x2 int, y1 int, y2 int, conf double", _each(_boxes), many=True),
    "diarise": Provider("start_ms long, end_ms long, label string", _each(lambda x: [(i * 1000, i * 1000 + int(r.randint(200, 1000)), f"SPEAKER_{r.randint(0, 3):02d}") for r in [_seed(("spk", x))] for i in range(5)]), many=True),
    "asr": Provider("raw string", _each(lambda x: (f"language English<asr_text>words of {x}.<|end|>",))),
    "vlm": Provider("description string", _each(lambda x: (f"picture {hashlib.sha256(repr(x).encode()).hexdigest()[:8]}",))),
    "llm": Provider("answer string", _each(lambda x: (_answer(x),))),
    "decode": Provider("frame int, luma double", _each(lambda x: [(i, float(round(r.uniform(0, 255), 3))) for r in [_seed(("dec", x))] for i in range(24)]), many=True),
}


def infer(df: DataFrame, name: str, column: str, keep: list[str], attempts: int = 3) -> DataFrame:
    """Keep columns and the provider's. A batch that fails is tried again row by row (X6); a row that fails
    `attempts` times has nulls, or no rows where a result is many."""
    provider = REGISTRY[name]
    added = T._parse_datatype_string(provider.schema)
    schema = T.StructType([*[df.schema[c] for c in keep], *added.fields])
    width, many, load = len(added.fields), provider.many, provider.load

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        model = load()

        def one(x):
            for _ in range(attempts):
                try:
                    return model([x])[0]
                except Exception:  # noqa: BLE001, S110  a model's failure is a missing result
                    pass
            return [] if many else (None,) * width

        for b in batches:
            inputs = b[column].tolist()
            try:
                results = model(inputs)
            except Exception:  # noqa: BLE001
                results = [one(x) for x in inputs]
            rows = [(*k, *r) for k, got in zip(b[keep].itertuples(index=False), results, strict=True) for r in (got if many else [got])]
            yield pd.DataFrame(rows, columns=[f.name for f in schema.fields])

    return df.select(*dict.fromkeys([*keep, column])).mapInPandas(run, schema)


def once_per(df: DataFrame, name: str, column: str, keep: list[str]) -> DataFrame:
    """Distinct inputs are inferred once and handed to every row that has them; null is an input like others."""
    results = infer(df.select(F.col(column).alias("_once")).distinct(), name, "_once", ["_once"])
    return df.select(*keep, F.col(column).alias("_in")).join(results, F.col("_in").eqNullSafe(F.col("_once"))).drop("_in", "_once")


def speaker_numbers(turns: DataFrame, key: list[str], order: str, label: str) -> DataFrame:
    """Labels to integers by first appearance."""
    from pyspark.sql import Window

    firsts = turns.groupBy(*key, label).agg(F.min(order).alias("_first"))
    ranked = firsts.withColumn("speaker", (F.row_number().over(Window.partitionBy(*key).orderBy("_first", label)) - 1).cast("int"))
    return turns.join(ranked.drop("_first"), [*key, label])
