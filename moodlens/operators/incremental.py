"""Training in steps with saved states, and the curve of losses over them.

The rows are written once, dealt into ``steps`` batches by the hash of their id.  Step ``s`` reads batch ``s`` only,
moves the weights against its gradient (AdaGrad: each weight's step shrinks with its squared gradients so far)
and writes the new state as a Parquet table ``step=s`` in the shared folder.  The curve scores a fixed held-out
part from saved states.  Batches, sums and states do not depend on partitions or on where a run was broken off:
continued from any saved step, a fit gives the same rows.
"""

from __future__ import annotations

import os
import uuid

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import ensure_checkpoint_dir
from .features import hash_bucket
from .linear import SLICE, LinearModel, check_model_size, class_rows, run_pass

STATE = "slice int, weights binary, squares binary, loss double, labels array<double>, n_terms long"


class IncrementalFit:
    """Softmax classifier of ``train (doc_id, label, ids, x)``; ``folder`` names an earlier fit to go on with."""

    def __init__(self, train: DataFrame, n_terms: int, labels: list | None = None, steps: int = 15, rate: float = 0.5, folder: str | None = None):
        self.spark: SparkSession = train.sparkSession
        rows, self.labels = class_rows(train, labels=labels)
        check_model_size(n_terms, len(self.labels))
        self.n_terms, self.steps, self.rate = n_terms, steps, rate
        self.folder = folder or os.path.join(ensure_checkpoint_dir(self.spark), "moodlens-steps", uuid.uuid4().hex)
        if folder is None:
            batch = hash_bucket(F.concat_ws("|", F.lit("step"), F.col("doc_id").cast("string")), steps)
            rows.select("y", "ids", "x", batch.alias("batch")).write.partitionBy("batch").parquet(self._path("rows"))
        self.rows = self.spark.read.schema("y int, ids array<int>, x array<double>, batch int").parquet(self._path("rows"))

    def _path(self, name: str) -> str:
        return os.path.join(self.folder, name)

    def _save(self, step: int, w: np.ndarray, h: np.ndarray, loss: float) -> None:
        state = [(i, bytearray(w[a : a + SLICE].tobytes()), bytearray(h[a : a + SLICE].tobytes()), loss, [float(x) for x in self.labels], self.n_terms) for i, a in enumerate(range(0, len(w), SLICE))]
        self.spark.createDataFrame(state, STATE).write.mode("overwrite").parquet(self._path(f"step={step}"))

    def state(self, step: int) -> tuple[np.ndarray, np.ndarray, float]:
        """Weights, squared gradients and mean loss of the step's batch (before the move)."""
        if step == 0:
            shape = (self.n_terms + 1, len(self.labels))
            return np.zeros(shape), np.zeros(shape), float("nan")
        rows = self.spark.read.schema(STATE).parquet(self._path(f"step={step}")).orderBy("slice").collect()  # the size of the model
        w, h = (np.frombuffer(b"".join(bytes(r[n]) for r in rows), np.float64).reshape(-1, len(self.labels)) for n in ("weights", "squares"))
        return w, h, rows[0]["loss"]

    def run(self, done: int = 0) -> "IncrementalFit":
        """All steps after ``done``."""
        w, h, _ = self.state(done)
        for step in range(done + 1, self.steps + 1):
            batch = self.rows.where(F.col("batch") == step - 1)
            loss, _, n, (grad, _) = run_pass(batch, "softmax", w)
            if n:
                grad = grad / n
                h = h + grad * grad
                w = w - self.rate * grad / (np.sqrt(h) + 1e-10)
            self._save(step, w, h, loss / n if n else 0.0)
        return self

    def model(self, step: int) -> LinearModel:
        return LinearModel(self.labels, self.state(step)[0])

    def curve(self, held_out: DataFrame, every: int = 3) -> DataFrame:
        """``(step, train_loss, validation_loss, accuracy)`` at each ``every``-th step: the mean loss of the steps since
        the last one (each of its batch before the move), and loss and accuracy of the state on ``held_out``."""
        rows, _ = class_rows(held_out, labels=self.labels)
        out = []
        for step in range(every, self.steps + 1, every):
            w = self.state(step)[0]
            losses = [self.state(s)[2] for s in range(step - every + 1, step + 1)]
            loss, right, n, _ = run_pass(rows.where("y is not null"), "softmax", w, held=True)
            total = held_out.count() if n else 0
            out.append((step, float(np.mean(losses)), loss / n if n else None, right / total if total else None))
        return self.spark.createDataFrame(out, "step int, train_loss double, validation_loss double, accuracy double")
