"""Secret scans: fixed patterns, and a character convolutional network over every other candidate.

Candidates are runs of token characters that hold a digit. The network reads a candidate with the
characters around it: an embedding of characters, one convolution, the largest and the mean response
inside the candidate, a logistic unit. It is trained on all findings of the corpus but those held out, labelled by
whether a pattern covers them, in tasks whose networks are averaged after every round; its outputs are calibrated on
all findings of a fold kept apart, and a threshold is the highest that still finds the asked share of the labelled
secrets there.
"""

from __future__ import annotations

import io
import re

import numpy as np
import pyarrow as pa
from pyspark import StorageLevel, TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sluicegate.llm.common import Batches, Scratch, fields, held_out, kept, map_batches, parts, texts_of

# Patterns of secrets, and how long a finding must be. Kinds are listed in this order.
ASSIGN = re.compile(
    r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.IGNORECASE | re.ASCII
)
ACCESS = re.compile("AKIA[A-Z0-9]+")
HEX = re.compile("[0-9a-f]{16,}")
ASSIGN_LENGTH, ACCESS_LENGTH = 12, 18
KINDS = ("assign", "access", "hex", "network")

# Findings that one task trains on, where there are not more of them than this for each of the most tasks.
TASK_FINDINGS, MOST_TASKS = 8000, 256
EPOCHS = 12
# Findings of a training step, and places that they may have together, unless one alone has more.
STEP_FINDINGS, STEP_PLACES = 64, 1 << 16
# Parts of one in which outputs are counted, and their bounds.
OUTPUT_PARTS, OUTPUT_BOUND = 256, 30
# Characters read before and after a candidate.
CONTEXT = 24
LEAST_LENGTH = 12

_DIGIT = re.compile("[0-9]+")
_AFTER = re.compile("[A-Za-z0-9+/_.=-]*")
_TOKEN = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_.=-")

Span = tuple[str, int, int]


def pattern_spans(text: str) -> list[Span]:
    """What the patterns find, by start and kind: kind, first, past the last character."""
    found: list[Span] = []
    if ":" in text or "=" in text:
        found += [
            ("assign", *m.span()) for m in ASSIGN.finditer(text) if m.end(2) - m.start(2) >= ASSIGN_LENGTH
        ]
    if "AKIA" in text:
        found += [("access", *m.span()) for m in ACCESS.finditer(text) if m.end() - m.start() >= ACCESS_LENGTH]
    found += [("hex", *m.span()) for m in HEX.finditer(text)]
    return sorted(found, key=_order)


def _order(span: Span) -> tuple[int, int]:
    return span[1], KINDS.index(span[0])


def candidates(text: str) -> list[tuple[int, int]]:
    """Runs of token characters, 12 or longer, with a digit."""
    found, position = [], 0
    while digit := _DIGIT.search(text, position):
        start, end = digit.start(), _AFTER.match(text, digit.end()).end()
        while start > position and text[start - 1] in _TOKEN:
            start -= 1
        if end - start >= LEAST_LENGTH:
            found.append((start, end))
        position = end
    return found


def joined(spans: list[Span]) -> str:
    return ",".join(f"{kind}:{start}:{end}" for kind, start, end in spans)


class Window:
    """A candidate with its surroundings, as the network reads it."""

    __slots__ = ("text", "inside")

    def __init__(self, text: str, start: int, end: int):
        before = text[max(0, start - CONTEXT) : start]
        self.text = before + text[start:end] + text[end : end + CONTEXT]
        self.inside = len(before), len(before) + end - start


class Network:
    """One convolution over embedded characters, pooled inside the candidate."""

    CODES, EMBED, WIDTH, FILTERS = 98, 8, 5, 24

    def __init__(self, seed: int = 5):
        source = np.random.default_rng(seed)
        inputs = self.WIDTH * (self.EMBED + 1)
        self.weights = {
            "embed": source.normal(0, 0.3, (self.CODES, self.EMBED)),
            "filter": source.normal(0, (2 / inputs) ** 0.5, (inputs, self.FILTERS)),
            "bias": np.zeros(self.FILTERS),
            "out": source.normal(0, 0.1, 2 * self.FILTERS),
            "start": np.zeros(1),
        }
        # What training remembers between steps.
        self.first = {k: np.zeros_like(v) for k, v in self.weights.items()}
        self.second = {k: np.zeros_like(v) for k, v in self.weights.items()}
        self.steps = 0.0
        # Calibration of the output, and the lowest calibrated output that counts.
        self.slope, self.shift, self.threshold = 1.0, 0.0, 2.0

    def _encode(self, windows: list[Window]) -> tuple[np.ndarray, np.ndarray]:
        """Character codes and which places lie inside the candidates, padded to one length."""
        longest = max(len(w.text) for w in windows) + self.WIDTH - 1
        codes = np.zeros((len(windows), longest), np.int64)
        inside = np.zeros((len(windows), longest), bool)
        half = self.WIDTH // 2
        for row, window in enumerate(windows):
            points = np.frombuffer(window.text.encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.int64)
            printable = (points >= 32) & (points < 127)
            codes[row, half : half + len(points)] = np.where(printable, points - 30, 1)
            inside[row, half + window.inside[0] : half + window.inside[1]] = True
        return codes, inside

    def _forward(self, codes: np.ndarray, inside: np.ndarray) -> dict[str, np.ndarray]:
        w = self.weights
        x = np.concatenate([w["embed"][codes] * (codes > 0)[..., None], inside[..., None]], 2)
        places = x.shape[1] - self.WIDTH + 1
        stacked = np.concatenate([x[:, k : k + places] for k in range(self.WIDTH)], 2)
        response = np.maximum(stacked @ w["filter"] + w["bias"], 0)
        half = self.WIDTH // 2
        mask = inside[:, half : half + places]
        count = np.maximum(1, mask.sum(1))[:, None]
        masked = np.where(mask[..., None], response, 0)
        pooled = np.concatenate([masked.max(1), masked.sum(1) / count], 1)
        return {
            "stacked": stacked, "response": response, "mask": mask, "count": count,
            "best": masked.argmax(1), "pooled": pooled, "logit": pooled @ w["out"] + w["start"][0],
        }

    def _gradients(self, codes: np.ndarray, inside: np.ndarray, labels: np.ndarray) -> dict[str, np.ndarray]:
        f, w = self._forward(codes, inside), self.weights
        error = (1 / (1 + np.exp(-np.clip(f["logit"], -30, 30))) - labels) / len(labels)
        back = error[:, None] * w["out"]
        rows, filters = np.arange(len(codes))[:, None], np.arange(self.FILTERS)
        to_response = np.where(f["mask"][..., None], (back[:, self.FILTERS :] / f["count"])[:, None, :], 0.0)
        to_response[rows, f["best"], filters] += back[:, : self.FILTERS]
        to_response *= f["response"] > 0
        flat = to_response.reshape(-1, self.FILTERS)
        to_input = to_response @ w["filter"].T
        to_embed = np.zeros_like(w["embed"])
        width, places = self.EMBED + 1, f["mask"].shape[1]
        for k in range(self.WIDTH):
            np.add.at(
                to_embed,
                codes[:, k : k + places].ravel(),
                to_input[..., k * width : k * width + self.EMBED].reshape(-1, self.EMBED),
            )
        to_embed[0] = 0
        return {
            "embed": to_embed,
            "filter": f["stacked"].reshape(-1, self.WIDTH * width).T @ flat,
            "bias": flat.sum(0),
            "out": f["pooled"].T @ error,
            "start": error.sum(keepdims=True),
        }

    def state(self) -> np.ndarray:
        """All that training changes, as one row of numbers."""
        tables = [table[name].ravel() for table in (self.weights, self.first, self.second) for name in self.weights]
        return np.concatenate([*tables, [self.steps]])

    def restore(self, state: np.ndarray) -> None:
        at = 0
        for table in (self.weights, self.first, self.second):
            for name, old in table.items():
                table[name] = state[at : at + old.size].reshape(old.shape).copy()
                at += old.size
        self.steps = float(state[at])

    def train(self, windows: list[Window], labels: np.ndarray, epochs: range = range(EPOCHS), rate: float = 0.01) -> None:
        """Adam on the logistic loss, in batches of candidates of like length."""
        order = sorted(range(len(windows)), key=lambda i: len(windows[i].text))
        batches: list[list[int]] = []
        for i in order:
            places = len(windows[i].text)
            if not batches or len(batches[-1]) >= STEP_FINDINGS or (len(batches[-1]) + 1) * places > STEP_PLACES:
                batches.append([])
            batches[-1].append(i)
        for epoch in epochs:
            for number in np.random.default_rng([11, epoch]).permutation(len(batches)):
                own = batches[number]
                gradients = self._gradients(*self._encode([windows[i] for i in own]), labels[own])
                self.steps += 1
                for name, gradient in gradients.items():
                    self.first[name] += 0.1 * (gradient - self.first[name])
                    self.second[name] += 0.001 * (gradient**2 - self.second[name])
                    change = self.first[name] / (1 - 0.9**self.steps)
                    scale = np.sqrt(self.second[name] / (1 - 0.999**self.steps)) + 1e-8
                    self.weights[name] -= rate * change / scale

    def logits(self, windows: list[Window]) -> np.ndarray:
        """Outputs of all candidates, whole; long ones are read together with others of their length."""
        result = np.zeros(len(windows))
        order = np.argsort([len(w.text) for w in windows], kind="stable")
        start = 0
        while start < len(order):
            longest = len(windows[order[start]].text)
            end = start + max(1, min(256, 100_000 // max(1, longest)))
            while end > start + 1 and len(windows[order[min(end, len(order)) - 1]].text) > 2 * longest + 64:
                end = start + max(1, (end - start) // 2)
            own = order[start:end]
            result[own] = self._forward(*self._encode([windows[i] for i in own]))["logit"]
            start = end
        return result

    def probabilities(self, windows: list[Window]) -> np.ndarray:
        return self._share(self.logits(windows))

    def _share(self, outputs: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.slope * outputs + self.shift, -30, 30)))

    def calibrate(self, outputs: np.ndarray, labels: np.ndarray, counts: np.ndarray, recall: float) -> None:
        """Fit the output's scale, and set the highest threshold with the asked recall.

        Of findings it is given the lower ends of the parts that their outputs lie in, ascending, with their labels and numbers.
        """
        x = outputs + 0.5 / OUTPUT_PARTS
        # Shares of both labels are smoothed, so that findings told apart without error stay finite.
        positive, negative = counts[labels > 0].sum(), counts[labels == 0].sum()
        target = np.where(labels > 0, (positive + 1) / (positive + 2), 1 / (negative + 2))
        beta = np.array([1.0, 0.0])
        design = np.stack([x, np.ones_like(x)], 1)
        for _ in range(100):
            p = 1 / (1 + np.exp(-np.clip(design @ beta, -30, 30)))
            hessian = (design * (counts * np.maximum(p * (1 - p), 1e-9))[:, None]).T @ design + 1e-6 * np.eye(2)
            step = np.linalg.solve(hessian, design.T @ (counts * (target - p)))
            beta += step * min(1.0, 2.0 / max(1e-9, float(np.abs(step).max())))
            if np.abs(step).max() < 1e-8:
                break
        self.slope, self.shift = max(1e-3, float(beta[0])), float(beta[1])
        missed = np.cumsum(counts[labels > 0]) <= int((1 - recall) * positive)
        lowest = outputs[labels > 0][missed.sum()]
        self.threshold = max(0.5, float(self._share(lowest)))

    def to_bytes(self) -> bytes:
        buffer = io.BytesIO()
        np.savez(buffer, calibration=[self.slope, self.shift, self.threshold], **self.weights)
        return buffer.getvalue()


def _loaded(data: bytes) -> Network:
    network = Network()
    with np.load(io.BytesIO(data)) as parts:
        network.weights = {name: parts[name] for name in network.weights}
        network.slope, network.shift, network.threshold = parts["calibration"].tolist()
    return network


def _findings(batches: Batches) -> Batches:
    """Candidates with their surroundings, and whether a pattern covers a part of them."""
    for batch in parts(batches):
        rows = []
        for text, fold in zip(texts_of(batch, "text"), batch.column("fold").to_pylist(), strict=True):
            spans = pattern_spans(text)
            for start, end in candidates(text):
                window = Window(text, start, end)
                label = any(s < end and e > start for _, s, e in spans)
                rows.append((window.text, *window.inside, label, fold))
        columns = list(zip(*rows, strict=True)) or [[]] * 5
        kinds = [pa.string(), pa.int32(), pa.int32(), pa.bool_(), pa.int32()]
        yield pa.RecordBatch.from_arrays(
            [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)],
            names=["window", "first", "past", "secret", "fold"],
        )


def _windows(batch: pa.RecordBatch) -> list[Window]:
    windows = []
    for text, *inside in zip(*[batch.column(name).to_pylist() for name in ("window", "first", "past")], strict=True):
        windows.append(Window("", 0, 0))
        windows[-1].text, windows[-1].inside = text, tuple(inside)
    return windows


def _trained(state: bytes, epochs: range):
    """A network that goes on from a state with a task's own findings."""

    def run(batches: Batches) -> Batches:
        windows, labels = [], []
        for batch in batches:
            windows += _windows(batch)
            labels += batch.column("secret").to_pylist()
        if windows:
            network = Network()
            network.restore(np.frombuffer(state))
            network.train(windows, np.array(labels, float), epochs)
            yield pa.RecordBatch.from_arrays(
                [pa.array([TaskContext.get().partitionId()], pa.int32()), pa.array([len(windows)], pa.int64()),
                 pa.array([network.state().tobytes()], pa.binary())],
                names=["part", "n", "state"],
            )

    return run


def _scored(state: bytes):
    """Which part of the outputs each finding lies in, and its label."""

    def run(batches: Batches) -> Batches:
        network = Network()
        network.restore(np.frombuffer(state))
        for batch in parts(batches):
            outputs = np.clip(network.logits(_windows(batch)), -OUTPUT_BOUND, OUTPUT_BOUND)
            places = pa.array(np.floor(outputs * OUTPUT_PARTS).astype(np.int32))
            yield pa.RecordBatch.from_arrays([places, batch.column("secret")], names=["output", "secret"])

    return run


def learn(df: DataFrame, recall: float = 0.99, id_col: str = "doc_id", text_col: str = "text") -> Network | None:
    """A network trained on every distinct finding of every document that is not held out.

    Three folds of documents are trained on, the fourth gives the calibration and the threshold. Findings are dealt to
    tasks by their hash, some thousand to each. A round is an epoch in every task, from the same network; the
    driver gets one network from each of at most ``MOST_TASKS`` tasks and averages them by their findings. A single
    task runs all rounds at once. Outputs are counted in parts of 1/256, so the threshold is exact to
    such a part. None if the folds trained on, or the fourth, lack a label.
    """
    fold = (F.crc32(df[id_col].cast("string").cast("binary")) % 5).cast("int")
    rows = df.where(~held_out(df[id_col])).select(df[text_col].alias("text"), fold.alias("fold"))
    found = map_batches(rows, _findings, "window string, first int, past int, secret boolean, fold int")
    key = ["window", "first", "past", "secret"]
    scratch = Scratch(df.sparkSession)
    found = scratch.table(found.groupBy(*key).agg((F.min("fold") == 4).alias("apart")), "findings")
    counts = {(row.apart, row.secret): row["count"] for row in found.groupBy("apart", "secret").count().collect()}
    network = None
    if len(counts) == 4:
        tasks = min(MOST_TASKS, -(-(counts[False, False] + counts[False, True]) // TASK_FINDINGS))
        dealt = found.where("NOT apart").repartition(tasks, *key).sortWithinPartitions(*key).persist(StorageLevel.MEMORY_AND_DISK)
        network = Network()
        for epochs in [range(EPOCHS)] if tasks == 1 else [range(i, i + 1) for i in range(EPOCHS)]:
            run = _trained(network.state().tobytes(), epochs)
            trained = map_batches(dealt, run, "part int, n long, state binary").toArrow().sort_by("part")
            states = [np.frombuffer(state) for state in trained.column("state").to_pylist()]
            network.restore(np.average(states, axis=0, weights=trained.column("n").to_numpy()))
        dealt.unpersist()
        scored = map_batches(found.where("apart"), _scored(network.state().tobytes()), "output int, secret boolean")
        outputs = scored.groupBy("output", "secret").count().orderBy("output", "secret").toArrow()
        network.calibrate(
            outputs.column("output").to_numpy() / OUTPUT_PARTS,
            outputs.column("secret").to_numpy().astype(float),
            outputs.column("count").to_numpy(),
            recall,
        )
    scratch.drop("findings")
    return network


def scan_secrets(
    df: DataFrame,
    recall: float = 0.99,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """Secrets in every whole text: ``doc_id`` and ``findings``, a list of ``kind``, ``first``, ``past``.

    Findings of the patterns come first in judgement and always stay; the network adds candidates that
    no pattern touches and that reach its threshold (kind ``network``). Findings are listed by start,
    then in the order of the kinds; places are code points, ``past`` exclusive.

    A null text counts as empty and has no findings. Without labelled findings of both kinds in the
    training folds no network is made and the patterns stand alone. Repeated rows are scanned each on
    its own, null ids stay null, other columns are not read; an empty table gives an empty result.
    """
    network = learn(df, recall, id_col, text_col)
    shared = df.sparkSession.sparkContext.broadcast(network.to_bytes() if network else None)
    kind = pa.list_(pa.struct([("kind", pa.string()), ("first", pa.int32()), ("past", pa.int32())]))
    finding = T.StructType(
        [T.StructField("kind", T.StringType()), *[T.StructField(n, T.IntegerType()) for n in ("first", "past")]]
    )
    schema = T.StructType([*fields(df, {"doc_id": id_col}), T.StructField("findings", T.ArrayType(finding))])

    def scanned(batches: Batches) -> Batches:
        own = kept(_loaded, shared.value) if shared.value else None
        for batch in parts(batches):
            found = _found(own, texts_of(batch, "text"))
            lists = [[{"kind": k, "first": s, "past": e} for k, s, e in spans] for spans in found]
            yield pa.RecordBatch.from_arrays([batch.column("id"), pa.array(lists, kind)], names=["doc_id", "findings"])

    return map_batches(df.select(df[id_col].alias("id"), df[text_col].alias("text")), scanned, schema)


def _found(network: Network | None, texts: list[str]) -> list[list[Span]]:
    """What the patterns find in each text, and the candidates beside that the network takes for secrets."""
    found = [pattern_spans(text) for text in texts]
    places, windows = [], []
    for row, text in enumerate(texts if network else []):
        for start, end in candidates(text):
            if not any(s < end and e > start for _, s, e in found[row]):
                places.append((row, start, end))
                windows.append(Window(text, start, end))
    if windows:
        for (row, start, end), p in zip(places, network.probabilities(windows), strict=True):
            if p >= network.threshold:
                found[row] = sorted([*found[row], ("network", start, end)], key=_order)
    return found


def digest(scanned: DataFrame) -> DataFrame:
    """Numbers of findings, the checksum of the patterns' findings, and all findings as text."""
    base = F.filter("findings", lambda f: f["kind"] != "network")

    def as_text(findings):
        return F.array_join(F.transform(findings, lambda f: F.format_string("%s:%d:%d", f["kind"], f["first"], f["past"])), ",")

    def number(kind):
        return F.size(F.filter("findings", lambda f: f["kind"] == kind)).cast("long").alias(f"n_{kind}")

    return scanned.select(
        "doc_id",
        *map(number, KINDS),
        F.sha2(as_text(base).cast("binary"), 256).alias("base_sha256"),
        as_text(F.col("findings")).alias("spans"),
    )


def redacted(text: str, spans: list[Span], mark: str) -> str:
    """A text with every stretch of overlapping or touching findings replaced by a mark."""
    parts, position = [], 0
    for _, start, end in spans:
        if not parts or start > position:
            parts += [text[position:start], mark]
        position = max(position, end)
    return "".join([*parts, text[position:]])


def redact(
    df: DataFrame,
    mark: str = "[secret]",
    recall: float = 0.99,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """Whole rows with every finding in the text replaced by a mark; cases as in ``scan_secrets``.

    Null texts stay null. Texts without findings stay as they are, byte for byte.
    """
    network = learn(df, recall, id_col, text_col)
    shared = df.sparkSession.sparkContext.broadcast(network.to_bytes() if network else None)
    place = df.columns.index(text_col)

    def rewritten(batches: Batches) -> Batches:
        own = kept(_loaded, shared.value) if shared.value else None
        for batch in parts(batches):
            texts = batch.column(place).to_pylist()
            found = _found(own, [text or "" for text in texts])
            texts = [redacted(t, spans, mark) if spans else t for t, spans in zip(texts, found, strict=True)]
            field = batch.schema.field(place)
            yield batch.set_column(place, field, pa.array(texts, field.type))

    return map_batches(df, rewritten, df.schema)
