"""Models behind one interface: loaded once in each worker, run once for each Arrow batch."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from typing import Any, Protocol

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql.types import StructType

from .audio.pcm import RATE, log_power, windows

_loaded: dict[str, Any] = {}


class Scorer(Protocol):
    """``output`` is the DDL of the columns that ``score`` adds, in the order and number of the rows it gets."""

    key: str
    output: str

    def open(self) -> Any: ...

    def score(self, state: Any, rows: pd.DataFrame) -> pd.DataFrame: ...


def state_of(scorer: Scorer) -> Any:
    if scorer.key not in _loaded:
        _loaded[scorer.key] = scorer.open()
    return _loaded[scorer.key]


def run_scorer(df: DataFrame, scorer: Scorer, on_error: str = "fail", drop: tuple[str, ...] = (), batch: int = 64) -> DataFrame:
    """``df`` with the scorer's columns and ``score_error``.

    A batch that fails is tried row by row; of the rows that fail then, ``fail``
    raises, ``drop`` leaves them out, ``record`` keeps them with the error and
    ``passthrough`` keeps them without. Columns in ``drop`` (waveforms) are not
    returned. The plan has one Python stage; put cheap filters before it.
    """
    if on_error not in ("fail", "drop", "record", "passthrough"):
        raise ValueError(f"unknown policy {on_error}")
    names = StructType.fromDDL(scorer.output).names
    kept = [c for c in df.columns if c not in drop]

    def one(state: Any, rows: pd.DataFrame) -> pd.DataFrame:
        out = scorer.score(state, rows)
        if len(out) != len(rows):
            raise ValueError(f"{scorer.key} returned {len(out)} rows for {len(rows)}")
        return out[names].reset_index(drop=True).assign(score_error=None)

    def rows(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        state = state_of(scorer)
        for whole in batches:
            for at in range(0, len(whole), batch):
                part = whole.iloc[at : at + batch].reset_index(drop=True)
                try:
                    found = one(state, part)
                except Exception:
                    if on_error == "fail":
                        raise
                    each, good = [], []
                    for k in range(len(part)):
                        try:
                            each.append(one(state, part.iloc[k : k + 1].reset_index(drop=True)))
                            good.append(True)
                        except Exception as e:
                            each.append(pd.DataFrame({**{n: [None] for n in names}, "score_error": [str(e)[:200] if on_error == "record" else None]}))
                            good.append(on_error != "drop")
                    found = pd.concat(each, ignore_index=True)[good].reset_index(drop=True)
                    part = part[good].reset_index(drop=True)
                yield pd.concat([part[kept], found], axis=1)

    types = dict(df.dtypes)
    ddl = ", ".join(f"`{c}` {types[c]}" for c in kept)
    return df.mapInPandas(rows, f"{ddl}, {scorer.output}, score_error string")


class EnergyVad:
    """Test scorer, no speech model: runs of frames above a level, as ``segments`` of each row's ``pcm``."""

    output = "segments array<struct<start_sec: double, end_sec: double, duration_sec: double>>"

    def __init__(self, level: float = 0.01, frame: int = 160, merge: int = 30, min_sec: float = 0.2):
        self.key = f"energy-vad-{level}-{frame}-{merge}-{min_sec}"
        self.level, self.frame, self.merge, self.min_sec = level, frame, merge, min_sec

    def open(self) -> None:
        return None

    def score(self, state: None, rows: pd.DataFrame) -> pd.DataFrame:
        return pd.DataFrame({"segments": [self.segments(np.frombuffer(p or b"", "<f4")) for p in rows["pcm"]]})

    def segments(self, x: np.ndarray) -> list[dict]:
        n = len(x) // self.frame
        loud = np.flatnonzero(np.sqrt((x[: n * self.frame].reshape(n, -1) ** 2).mean(axis=1)) > self.level) if n else np.zeros(0, int)
        if not len(loud):
            return []
        runs = np.split(loud, np.flatnonzero(np.diff(loud) > self.merge) + 1)
        step = self.frame / RATE
        spans = [(round(float(r[0] * step), 3), round(float((r[-1] + 1) * step), 3)) for r in runs]
        return [{"start_sec": a, "end_sec": b, "duration_sec": round(b - a, 3)} for a, b in spans if b - a >= self.min_sec]


class WindowedOnnx:
    """Scores of ONNX graphs over the 9-second log-power windows of each row's ``pcm``, averaged; needs onnxruntime and the graphs' files."""

    output = "raw_sig double, raw_bak double, raw_ovr double"

    def __init__(self, sig_path: str, bak_ovr_path: str, padding: str = "double"):
        self.key = f"onnx-{sig_path}-{bak_ovr_path}"
        self.paths, self.padding = (sig_path, bak_ovr_path), padding

    def open(self) -> list:
        try:
            import onnxruntime
        except ImportError as e:
            raise RuntimeError("onnxruntime is not installed") from e
        return [onnxruntime.InferenceSession(p, providers=["CPUExecutionProvider"]) for p in self.paths]

    def score(self, state: list, rows: pd.DataFrame) -> pd.DataFrame:
        out = []
        for pcm in rows["pcm"]:
            each = []
            for x in windows(np.frombuffer(pcm, "<f4"), self.padding):
                feature = log_power(x).astype(np.float32)[None]
                sig, both = (np.ravel(s.run(None, {s.get_inputs()[0].name: feature})[0]) for s in state)
                each.append((sig[0], both[1], both[2]))
            out.append(np.mean(each, axis=0) if each else [None] * 3)
        return pd.DataFrame(out, columns=["raw_sig", "raw_bak", "raw_ovr"])


def samples_of(rows: pd.DataFrame) -> Iterator[np.ndarray]:
    """Each row's ``pcm`` as a (1, samples) tensor."""
    for pcm in rows["pcm"]:
        if pcm is None:
            raise ValueError("no samples")
        yield np.frombuffer(pcm, "<f4")[None].astype(np.float32)


class Graph:
    """Any model with an ONNX file: speech frames, language, speaker vectors or quality.

    ``prepare`` makes one input tensor of each row, ``finish`` the output columns
    of the rows' results; the file is loaded once in each worker.
    """

    def __init__(self, path: str, output: str, prepare: Callable[[pd.DataFrame], Iterator[np.ndarray]], finish: Callable[[list, pd.DataFrame], dict[str, list]]):
        self.key, self.path, self.output, self.prepare, self.finish = f"graph-{path}-{output}", path, output, prepare, finish

    def open(self) -> Any:
        try:
            import onnxruntime
        except ImportError as e:
            raise RuntimeError("onnxruntime is not installed") from e
        return onnxruntime.InferenceSession(self.path, providers=["CPUExecutionProvider"])

    def score(self, state: Any, rows: pd.DataFrame) -> pd.DataFrame:
        name = state.get_inputs()[0].name
        return pd.DataFrame(self.finish([state.run(None, {name: x}) for x in self.prepare(rows)], rows))


class Precomputed:
    """Test scorer: looks a row's ``key_col`` up in a fixed table of values."""

    def __init__(self, key: str, key_col: str, output: str, table: dict[str, tuple]):
        self.key, self.key_col, self.output, self.table = key, key_col, output, table

    def open(self) -> dict[str, tuple]:
        return self.table

    def score(self, state: dict[str, tuple], rows: pd.DataFrame) -> pd.DataFrame:
        return pd.DataFrame([state[k] for k in rows[self.key_col]], columns=[p.split()[0] for p in self.output.split(",")])
