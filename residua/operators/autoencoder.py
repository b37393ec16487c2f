"""Dense autoencoder trained on the executors in synchronous rounds.

Rows are dealt once, by hash, into blocks of a bounded number of rows; a segment is one block of every shard, and there are about as
many segments as shards: both grow with the root of the row count, so a larger table is trained side by side by more tasks and merged more
often, too, and needs fewer epochs instead of as many longer ones. A round broadcasts the state, trains every block of one segment from it by seeded mini-batch
Adam, and averages the states by the rows they saw; an epoch is a round per segment. So no task reads more than a block between two
merges, however large the table, and nothing depends on how many cores there are: blocks, their order inside an average, and
the random numbers all follow from the rows. The validation loss of a finished epoch is taken in the next epoch's first round.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from contextlib import contextmanager
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from residua.functions.materialize import materialize
from residua.operators import dense_net as net
from residua.operators.encode import EncoderModel
from residua.operators.reconstruct import DENSE_WIDTH, NumpyModel, compact_arrays, complete_rows, require_weights

#: Numbers of a state that travel as one row.
CHUNK = 65_536
#: States that one task averages.
MERGE_WAYS = 64
#: Bytes of states that the driver averages itself; more are averaged on the executors first.
COLLECTED_BYTES = 64 << 20
#: Rows of a block of validation rows, about, and of a forward pass without training.
CHECKED_ROWS, FORWARD_ROWS = 8192, 2048
_BLOCKS = "segment int, shard int, part int, rows long, num binary, cat binary"
_STATE = "chunk int, at long, rows long, steps double, loss double, state binary"


@dataclass(frozen=True)
class AutoencoderModel(NumpyModel):
    encoder: EncoderModel
    trained: dict[str, np.ndarray]
    running: dict[str, np.ndarray]
    losses: tuple[float, ...] = ()
    left_out: int = 0

    def weights(self) -> dict[str, np.ndarray]:
        return {"trained": self.trained, "running": self.running}

    @staticmethod
    def reconstruct(weights, z: np.ndarray, cat: np.ndarray) -> np.ndarray:
        return net.forward(weights["trained"], weights["running"], z, cat)[0]

    @staticmethod
    def wide_errors(weights, z: np.ndarray, cat: np.ndarray) -> np.ndarray:
        squares = weights.setdefault("squares", net.output_squares(weights["trained"], z.shape[1]))
        h = net.hidden(weights["trained"], weights["running"], z, cat)[0]
        return net.block_errors(weights["trained"], squares, h, z, cat)


@dataclass(frozen=True)
class Autoencoder:
    """Adam 1e-3 on the mean squared error; stops when the benign validation loss has not improved.

    Rows with a missing number are left out of training and validation (the model counts them in ``left_out``) and get no score.

    round_batches  most mini-batches of a block: what a task trains between two merges
    shards         most blocks that train side by side; the root of the number of blocks if that is less, never by the cluster's size
    """

    max_epochs: int = 100
    batch_size: int = 256
    patience: int = 5
    seed: int = 42
    round_batches: int = 128
    shards: int = 256

    def fit(self, train: DataFrame, validation: DataFrame, encoder: EncoderModel) -> AutoencoderModel:
        require_weights(encoder, "the autoencoder")
        rows, held_out = complete_rows(encoder.transform(train)), complete_rows(encoder.transform(validation))
        n_rows, n_held_out = rows.count(), held_out.count()
        if n_rows < 2:
            raise ValueError("at least 2 benign training rows without a missing number are needed")
        if n_held_out == 0:
            raise ValueError("no benign validation row without a missing number")
        left_out = train.count() + validation.count() - n_rows - n_held_out
        block = self.batch_size * self.round_batches
        shards = min(self.shards, math.ceil(math.sqrt(n_rows / block)))
        segments = math.ceil(n_rows / (shards * block))
        blocks = self._stage(rows, train.columns, shards, segments, encoder, "train")
        checked = self._stage(held_out, validation.columns, math.ceil(n_held_out / CHECKED_ROWS), 1, encoder, "validation")

        trained_layout, running_layout = net.shapes(encoder.width)
        layouts = [trained_layout, running_layout, trained_layout, trained_layout]
        trained, running = net.initial(encoder.width, self.seed)
        zeros = {n: np.zeros(s) for n, s in trained_layout.items()}
        state, steps = net.pack([trained, running, zeros, zeros]).astype(np.float32), 0.0
        best, best_loss, waited, losses = state, math.inf, 0, []
        for turn in range(self.max_epochs * segments + 1):
            epoch, segment = divmod(turn, segments)
            over = epoch == self.max_epochs
            tasks = [] if over else [blocks.filter(F.col("segment") == segment)]
            if segment == 0 and epoch:
                tasks.append(checked.withColumn("segment", F.lit(-1)))
            moved, steps, loss = self._round(tasks, encoder, layouts, state, steps, turn, shards)
            if loss is not None:  # of the state that this round began with
                if not math.isfinite(loss):
                    raise ValueError(f"the validation loss is {loss}: training diverged")
                losses.append(loss)
                if loss < best_loss:
                    best, best_loss, waited = state, loss, 0
                else:
                    waited += 1
                    if waited >= self.patience:
                        break
            state = moved
        trained, running = (({n: a.astype(float) for n, a in group.items()}) for group in net.unpack(best, layouts)[:2])
        return AutoencoderModel(encoder, trained, running, tuple(losses), left_out)

    def _stage(self, encoded: DataFrame, columns: list[str], shards: int, segments: int, encoder: EncoderModel, purpose: str) -> DataFrame:
        """Blocks of encoded rows in hash order, a file each. A block that equal hashes make too large becomes several."""
        order = F.xxhash64(F.lit(self.seed), *[F.col(f"`{c}`") for c in columns])
        dealt = encoded.select(
            # whole numbers: a quotient in floating point has no low bits left, and all rows would be in a few segments
            F.pmod(F.call_function("div", order, F.lit(shards)), F.lit(segments)).cast("int").alias("segment"),
            F.pmod(order, F.lit(shards)).cast("int").alias("shard"),
            order.alias("order"),
            "enc_num",
            "enc_cat",
        )
        tasks = min(shards * segments, 4096)
        dealt = dealt.repartition(tasks, "segment", "shard").sortWithinPartitions("segment", "shard", "order")
        n_num, n_cat = len(encoder.numeric), len(encoder.categorical)
        limit = 2 * self.batch_size * self.round_batches  # hashes are even: a block stays far below

        def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            open_block, part, z, cat = None, 0, [], []

            def closed() -> pa.RecordBatch:
                num, slots = np.vstack(z), np.vstack(cat)
                values = [open_block[0], open_block[1], part, len(num), num.astype(np.float32).tobytes(), slots.astype(np.int32).tobytes()]
                return pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip(values, _block_types(), strict=True)], names=[f.split()[0] for f in _BLOCKS.split(", ")])

            for batch in batches:
                keys = list(zip(batch.column("segment").to_pylist(), batch.column("shard").to_pylist(), strict=True))
                num, slots = compact_arrays(batch.column("enc_num"), batch.column("enc_cat"), n_num, n_cat)
                starts = [i for i in range(len(keys)) if i == 0 or keys[i] != keys[i - 1]]
                for a, b in zip(starts, [*starts[1:], len(keys)], strict=True):
                    if open_block is not None and (keys[a] != open_block or sum(map(len, z)) >= limit):
                        yield closed()
                        part = part + 1 if keys[a] == open_block else 0
                        z, cat = [], []
                    open_block = keys[a]
                    z.append(num[a:b])
                    cat.append(slots[a:b])
            if open_block is not None:
                yield closed()

        return materialize(dealt.mapInArrow(pack, _BLOCKS), f"{purpose}-blocks", by=("segment",), file_rows=1)

    def _round(self, tasks: list[DataFrame], encoder, layouts, state, steps, turn, shards) -> tuple[np.ndarray, float, float | None]:
        """Train the blocks of a segment from ``state``, average, and take the loss of ``state`` over blocks of segment -1."""
        spark = tasks[0].sparkSession
        shared = spark.sparkContext.broadcast(state)
        n_num, n_cat, width = len(encoder.numeric), len(encoder.categorical), encoder.width
        batch_size, seed = self.batch_size, self.seed

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for i in range(batch.num_rows):
                    segment, shard, part, rows, num, cat = (batch.column(c)[i].as_py() for c in ("segment", "shard", "part", "rows", "num", "cat"))
                    z = np.frombuffer(num, np.float32).reshape(rows, n_num)
                    slots = np.frombuffer(cat, np.int32).reshape(rows, n_cat)
                    trained, running, first, second = net.unpack(shared.value, layouts)
                    at = (shard << 20) + part
                    if segment < 0:
                        yield _loss_row(at, rows, _squared(trained, running, z, slots) / width)
                        continue
                    rng, step = np.random.default_rng([seed, turn, shard, part]), steps
                    for pick in _minibatches(rows, batch_size, rng):
                        step += 1
                        _, grads = net.gradients(trained, running, z[pick], slots[pick], rng)
                        net.adam_step(trained, first, second, grads, step)
                    if step > steps:
                        yield _state_rows(net.pack([trained, running, first, second]), at, rows, step)

        work = tasks[0] if len(tasks) == 1 else tasks[0].unionByName(tasks[1])
        out = work.mapInArrow(run, _STATE)
        try:
            with _a_task_a_file(spark, shards):
                if shards * state.nbytes > COLLECTED_BYTES:
                    out = _merged_on_executors(materialize(out, "states"), shards)
                table = out.toArrow()
        finally:
            shared.destroy()
        found = table.to_pylist()
        losses = [r for r in found if r["chunk"] < 0]
        seen = sum(r["rows"] for r in losses)
        loss = math.fsum(r["loss"] for r in losses) / seen if seen else None
        chunks: dict[int, list] = {}
        for r in found:
            if r["chunk"] >= 0:
                chunks.setdefault(r["chunk"], []).append(r)
        if not chunks:
            return state, steps, loss
        merged = [_average(chunks[c]) for c in sorted(chunks)]
        return np.concatenate([np.frombuffer(m["state"], np.float32) for m in merged]), merged[0]["steps"], loss


@contextmanager
def _a_task_a_file(spark: SparkSession, files: int) -> Iterator[None]:
    """Session setting under which so many small files are read by as many tasks: a block is little to read and much to train on."""
    name = "spark.sql.files.minPartitionNum"
    before = spark.conf.get(name, None)
    spark.conf.set(name, str(files))
    try:
        yield
    finally:
        spark.conf.unset(name) if before is None else spark.conf.set(name, before)


def _block_types() -> list[pa.DataType]:
    return [pa.int32(), pa.int32(), pa.int32(), pa.int64(), pa.binary(), pa.binary()]


def _squared(trained, running, z: np.ndarray, cat: np.ndarray) -> float:
    """Squared reconstruction error of a block, summed over rows and dimensions."""
    wide = len(trained["enc0_w"]) > DENSE_WIDTH
    if wide:  # differences of large sums: in double precision
        trained, running = ({n: a.astype(float) for n, a in group.items()} for group in (trained, running))
        squares = net.output_squares(trained, z.shape[1])
    total = 0.0
    for at in range(0, len(z), FORWARD_ROWS):
        part, slots = z[at : at + FORWARD_ROWS], cat[at : at + FORWARD_ROWS]
        if wide:
            part = part.astype(float)
            h = net.hidden(trained, running, part, slots)[0]
            total += float(net.block_errors(trained, squares, h, part, slots).sum())
        else:
            e = net.residual(net.forward(trained, running, part, slots)[0], part, slots)
            total += float(np.square(e).sum(dtype=float))
    return total


def _minibatches(rows: int, size: int, rng: np.random.Generator) -> Iterator[np.ndarray]:
    """Shuffled mini-batches of row numbers; a single last row joins the batch before it, as its variance would be 0."""
    order = rng.permutation(rows)
    cuts = list(range(0, rows, size))
    if len(cuts) > 1 and rows - cuts[-1] == 1:
        cuts.pop()
    for a, b in zip(cuts, [*cuts[1:], rows], strict=True):
        if b - a > 1:
            yield order[a:b]


def _record(columns: dict[str, list]) -> pa.RecordBatch:
    types = {"chunk": pa.int32(), "at": pa.int64(), "rows": pa.int64(), "steps": pa.float64(), "loss": pa.float64(), "state": pa.binary()}
    return pa.RecordBatch.from_arrays([pa.array(columns[n], t) for n, t in types.items()], names=list(types))


def _loss_row(at: int, rows: int, loss: float) -> pa.RecordBatch:
    return _record({"chunk": [-1], "at": [at], "rows": [rows], "steps": [0.0], "loss": [loss], "state": [None]})


def _state_rows(packed: np.ndarray, at: int, rows: int, steps: float) -> pa.RecordBatch:
    pieces = [packed[k : k + CHUNK].astype(np.float32).tobytes() for k in range(0, len(packed), CHUNK)]
    n = len(pieces)
    return _record({"chunk": list(range(n)), "at": [at] * n, "rows": [rows] * n, "steps": [steps] * n, "loss": [None] * n, "state": pieces})


def _average(rows: list[dict]) -> dict:
    """Mean of equally long state chunks, weighted by the rows each block had, added up in the order of the blocks."""
    rows = sorted(rows, key=lambda r: r["at"])
    total = sum(r["rows"] for r in rows)
    mean, steps = 0.0, 0.0
    for r in rows:
        share = r["rows"] / total
        mean = mean + share * np.frombuffer(r["state"], np.float32).astype(float)
        steps += share * r["steps"]
    return {"chunk": rows[0]["chunk"], "at": rows[0]["at"], "rows": total, "steps": steps, "loss": None, "state": mean.astype(np.float32).tobytes()}


def _merged_on_executors(states: DataFrame, shards: int) -> DataFrame:
    """One row per chunk of the state and branch of ``MERGE_WAYS`` shards, until one branch is left; losses stay as they are."""

    def merge(group: pa.Table) -> pa.Table:
        one = _average(group.drop_columns(["branch"]).to_pylist())
        return pa.Table.from_batches([_record({n: [v] for n, v in one.items()})])

    losses, merged, branches = states.filter("chunk < 0"), states.filter("chunk >= 0"), shards
    place = F.shiftright("at", 20)
    span = 1
    while branches > 1:
        span, branches = span * MERGE_WAYS, math.ceil(branches / MERGE_WAYS)
        merged = merged.withColumn("branch", F.floor(place / span)).groupBy("chunk", "branch").applyInArrow(merge, _STATE)
    return merged.unionByName(losses)
