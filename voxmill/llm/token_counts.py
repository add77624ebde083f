"""Token counts without tokens: Viterbi over Aho-Corasick matches carries only the best score and its piece count."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .unigram import UNIT, Lattices, parse

MODEL = "/opt/tokenizers/piece_bpe_32k.model"
_REMEMBERED = 400_000
_BATCH_CHARS = 1_000_000
_WHOLE_CHARS = 500_000


class Counter:
    """Counts the pieces of texts.

    For a unigram model whole texts are searched in its tokenizer's arithmetic. For
    other vocabularies sums are exact, so texts may be cut where no piece reaches
    across, and chunks seen before are remembered, up to a bound that only affects speed.
    """

    def __init__(self, model: bytes):
        self.lattices = Lattices(parse(model))
        self.known: dict[str, tuple[int, int]] = {}

    def _whole(self, texts: list[str]) -> tuple[list[int], list[float]]:
        counts, scores = np.zeros(len(texts), np.int64), np.zeros(len(texts))
        order = sorted(range(len(texts)), key=lambda k: len(texts[k]))  # texts of like length share their steps
        at = 0
        while at < len(order):
            some, held = at, 0
            while at < len(order) and held < _WHOLE_CHARS:
                held += len(texts[order[at]])
                at += 1
            rows = order[some:at]
            scores[rows], counts[rows] = self.lattices.single_counts([texts[k] for k in rows])
        return counts.tolist(), scores.tolist()

    def __call__(self, texts: list[str]) -> tuple[list[int], list[float]]:
        if self.lattices.vocab.single is not None:
            return self._whole(texts)
        parts = [self.lattices.chunks(t) for t in texts]
        if len(self.known) > _REMEMBERED:
            self.known.clear()
        new = list(set().union(*parts).difference(self.known))
        at = 0
        while at < len(new):
            some, held = at, 0
            while at < len(new) and held < _BATCH_CHARS:
                held += len(new[at])
                at += 1
            score, count = self.lattices.best_counts(new[some:at])
            self.known.update(zip(new[some:at], zip(count.tolist(), score.tolist())))
        counts, scores = [], []
        look = self.known.__getitem__
        for part in parts:
            n = s = 0
            for a, b in map(look, part):
                n += a
                s += b
            counts.append(n)
            scores.append(s / UNIT)
        return counts, scores


def _count_rows(batches: Iterator[pa.RecordBatch], model: bytes) -> Iterator[pa.RecordBatch]:
    counter = Counter(model)
    for batch in batches:
        for at in range(0, batch.num_rows, 256):
            part = batch.slice(at, 256)
            counts, scores = counter([t or "" for t in part.column(1).to_pylist()])
            yield pa.RecordBatch.from_arrays([part.column(0), pa.array(counts, pa.int64()), pa.array(scores, pa.float64())], names=["doc_id", "tokens", "log_prob"])


def count_tokens(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", model_path: str = MODEL) -> DataFrame:
    """(doc_id, tokens, log_prob): for each row the number of pieces of its best unigram segmentation and that one's score.

    The vocabulary file is read by the driver and sent to all workers. Whole
    texts are counted, for a unigram model exactly as its tokenizer does, for others
    by log-probabilities that ``unigram.parse`` gives to their pieces. Null and empty texts have 0 tokens; a null id stays null;
    repeated rows are counted each; of equally good segmentations the one that a
    left-to-right search with strict improvement finds is counted; an empty
    table gives no row; other columns are ignored.
    """
    with open(model_path, "rb") as f:
        sent = docs.sparkSession.sparkContext.broadcast(f.read())
    rows = docs.select(F.col(f"`{id_col}`").cast("bigint"), F.col(f"`{text_col}`").cast("string"))
    return rows.mapInArrow(lambda it: _count_rows(it, sent.value), "doc_id bigint, tokens bigint, log_prob double")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return count_tokens(spark.read.parquet(f"{sf_dir}/documents.parquet"))
