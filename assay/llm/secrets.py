"""Secret scans: rules give findings, and a character convolutional network judges every other candidate."""

from __future__ import annotations

import hashlib
import math
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from assay.llm.textkit import short_batches, slices
from assay.scratch import Scratch

#: The kinds of finding, in order, and their patterns; letters of "assign" match in either case.
KINDS = ["assign", "access", "hex", "model"]
_ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.IGNORECASE | re.ASCII)
_ACCESS = re.compile(r"AKIA[A-Z0-9]+")
_HEX = re.compile(r"[0-9a-f]{16,}")  # the runs of 16 and more among all maximal runs
_KEYS = ("password", "passwd", "secret", "token", "apikey", "api_key")
_BEFORE, _SPAN, _AFTER = 20, 44, 12
_BACK = 4
_WINDOW = _BEFORE + _SPAN + _AFTER
#: 0 end, 1 other, 2 space, 3-12 digits, 13-38 lower, 39-64 upper, then signs.
_SIGNS = "+/_.=-:\"'@"
_CODE = np.ones(128, np.int64)
_CODE[32] = 2
_CODE[48:58], _CODE[97:123], _CODE[65:91] = np.arange(3, 13), np.arange(13, 39), np.arange(39, 65)
for _k, _s in enumerate(_SIGNS):
    _CODE[ord(_s)] = 65 + _k
_CODES = 65 + len(_SIGNS)
_COLON = 65 + _SIGNS.index(":")
_MARKS, _QUOTES, _LEADS = ([65 + _SIGNS.index(_s) for _s in _some] for _some in ("+/=_", "\"'", ":="))
#: Windows that a sampling task remembers, so that it doesn't send one again.
_MOST_SEEN = 200_000

Span = tuple[int, int, int]  # start, kind, end


def rule_spans(text: str) -> list[Span]:
    """The rules' findings, leftmost and non-overlapping per kind, in order of start, then kind."""
    found: list[Span] = []
    low = text.lower()
    if any(k in low for k in _KEYS):
        found += [(m.start(), 0, m.end()) for m in _ASSIGN.finditer(text) if len(m[2]) >= 12]
    if "AKIA" in text:
        found += [(m.start(), 1, m.end()) for m in _ACCESS.finditer(text) if m.end() - m.start() >= 18]
    found += [(m.start(), 2, m.end()) for m in _HEX.finditer(text)]
    return sorted(found)


def _runs(codes: np.ndarray, least: int) -> tuple[np.ndarray, np.ndarray]:
    """Where the candidates of coded texts begin and end (``candidates``)."""
    token = (codes >= 3) & (codes < _COLON)
    edge = np.flatnonzero(np.diff(np.concatenate([[False], token, [False]]).astype(np.int8)))
    lo, hi = edge[::2], edge[1::2]
    lo, hi = lo[hi - lo >= least], hi[hi - lo >= least]
    digit, lower, upper = codes < 13, (codes >= 13) & (codes < 39), (codes >= 39) & (codes < 65)
    total = lambda mask: np.concatenate([[0], np.cumsum(mask, dtype=np.int32)])
    marked = total(digit & (codes >= 3) | np.isin(codes, _MARKS))
    turns = total(np.concatenate([[False], lower[:-1] & upper[1:]]) if len(codes) else upper)
    letters = lower | upper
    keep = (marked[hi] > marked[lo]) | (turns[hi] > turns[lo + 1])
    count = total(letters)
    # twelve letters and more behind a colon or an equals sign, with spaces and a quote between
    last = np.maximum.accumulate(np.where(codes == 2, -1, np.arange(len(codes)))) if len(codes) else codes
    at = lo - 1
    at = np.where((at >= 0) & np.isin(codes[np.maximum(at, 0)], _QUOTES), at - 1, at)
    at = np.where(at >= 0, last[np.maximum(at, 0)], -1)
    behind = (at >= 0) & np.isin(codes[np.maximum(at, 0)], _LEADS)
    keep |= behind & (hi - lo >= 12) & (count[np.minimum(lo + 12, hi)] - count[lo] == 12)
    for k in np.flatnonzero(~keep & (hi - lo >= 25)):
        keep[k] = b"\1" * 25 in letters[lo[k] : hi[k]].tobytes()
    return lo[keep], hi[keep]


def _candidates(texts: list[str], least: int = 8) -> Iterator[tuple[np.ndarray, list[tuple[int, int]]]]:
    """The codes and candidates of each text; short texts are looked at together."""
    for first, behind in slices([len(t) for t in texts]):
        codes = _codes("\n".join(texts[first:behind]))
        begin = np.cumsum([0] + [len(t) + 1 for t in texts[first:behind]])
        lo, hi = _runs(codes, least)
        cut = np.searchsorted(lo, begin)
        for k, a in enumerate(begin[:-1].tolist()):
            yield codes[a : a + len(texts[first + k])], list(zip((lo[cut[k] : cut[k + 1]] - a).tolist(), (hi[cut[k] : cut[k + 1]] - a).tolist()))


def candidates(text: str, least: int = 8) -> list[tuple[int, int]]:
    """Every run of token characters of ``least`` and more that isn't plain prose.

    Prose are runs without a digit, a capital after a small letter, a sign of ``+/=_`` or 25 letters on end, unless 12 and more
    letters follow a colon or an equals sign.
    """
    return next(_candidates([text], least))[1]


def _apart(runs: list[tuple[int, int]], rules: list[Span]) -> list[tuple[tuple[int, int], bool]]:
    """The runs that no finding of the rules holds whole, and whether they meet none at all; both lists are in order, and one sweep suffices."""
    out, k, reach = [], 0, -1
    for lo, hi in runs:
        while k < len(rules) and rules[k][0] <= lo:
            reach = max(reach, rules[k][2])
            k += 1
        if reach < hi:
            out.append(((lo, hi), reach <= lo and not (k < len(rules) and rules[k][0] < hi)))
    return out


def _codes(text: str) -> np.ndarray:
    points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), "<u4")
    return np.where(points < 128, _CODE[np.minimum(points, 127)], 1).astype(np.uint8)


def _view(codes: np.ndarray, start: int, end: int) -> np.ndarray:
    out = np.zeros(_WINDOW, np.uint8)
    before, after = codes[max(0, start - _BEFORE) : start], codes[end : end + _AFTER]
    out[_BEFORE - len(before) : _BEFORE] = before
    if end - start > _SPAN:
        out[_BEFORE : _BEFORE + _SPAN // 2], out[_BEFORE + _SPAN // 2 : _BEFORE + _SPAN] = codes[start : start + _SPAN // 2], codes[end - _SPAN // 2 : end]
    else:
        out[_BEFORE : _BEFORE + end - start] = codes[start:end]
    out[_BEFORE + _SPAN : _BEFORE + _SPAN + len(after)] = after
    return out


def window(text: str, start: int, end: int) -> np.ndarray:
    """Codes of the characters before, in and after a span; of a longer span the two ends (``pieces`` gives the rest)."""
    lo = max(0, start - _BEFORE)
    return _view(_codes(text[lo : end + _AFTER]), start - lo, end - lo).astype(np.int64)


#: Slopes and offsets that the calibration chooses from.
_SCALES = [(float(a), float(b)) for a in np.geomspace(0.1, 2, 15) for b in np.linspace(-3, 3, 13)]


class Network:
    """Embedding, one convolution, maxima over the span and over its surroundings, one hidden layer.

    Beside its embedding a character has a mark for each of the four before it that it equals, so that repetition looks alike whatever repeats.
    """

    def __init__(self, seed: int = 7, embed: int = 8, filters: int = 24, hidden: int = 16, reach: int = 5):
        rng = np.random.default_rng(seed)
        draw = lambda *s: rng.normal(0, (2 / s[0]) ** 0.5, s)
        self.reach = reach
        self.p = {"e": rng.normal(0, 0.5, (_CODES, embed)), "k": draw(reach * (embed + _BACK), filters), "kb": np.zeros(filters), "h": draw(2 * filters, hidden), "hb": np.zeros(hidden), "o": draw(hidden, 1), "ob": np.zeros(1)}
        self.inside = slice(_BEFORE - reach // 2, _BEFORE + _SPAN - reach // 2)
        self.slope, self.offset, self.threshold = 1.0, 0.0, 0.5

    def _forward(self, x: np.ndarray) -> tuple:
        p = self.p
        same = np.zeros((*x.shape, _BACK))
        for k in range(_BACK):
            same[:, k + 1 :, k] = (x[:, k + 1 :] == x[:, : -k - 1]) & (x[:, k + 1 :] > 0)
        e = np.concatenate([p["e"][x], same], axis=2)
        cols = np.concatenate([e[:, j : _WINDOW - self.reach + 1 + j] for j in range(self.reach)], axis=2)
        c = np.maximum(0, cols @ p["k"] + p["kb"])
        inside, around = c[:, self.inside].argmax(axis=1) + self.inside.start, c.copy()
        around[:, self.inside] = -1
        at = [inside, around.argmax(axis=1)]
        top = np.concatenate([np.take_along_axis(c, a[:, None], 1)[:, 0] for a in at], axis=1)
        h = np.maximum(0, top @ p["h"] + p["hb"])
        return cols, c, at, top, h, (h @ p["o"] + p["ob"])[:, 0]

    def logits(self, x: np.ndarray) -> np.ndarray:
        return np.concatenate([self._forward(x[k : k + 512])[-1] for k in range(0, len(x), 512)]) if len(x) else np.zeros(0)

    def probability(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.slope * self.logits(x) + self.offset, -40, 40)))

    def _gradients(self, x: np.ndarray, y: np.ndarray) -> dict[str, np.ndarray]:
        p, n = self.p, len(x)
        cols, c, at, top, h, logit = self._forward(x)
        d = (1 / (1 + np.exp(-np.clip(logit, -40, 40))) - y)[:, None] / n
        g = {"o": h.T @ d, "ob": d.sum(0)}
        dh = (d @ p["o"].T) * (h > 0)
        g["h"], g["hb"] = top.T @ dh, dh.sum(0)
        dtop = dh @ p["h"].T
        dc = np.zeros_like(c)
        f = c.shape[2]
        for part, a in zip((dtop[:, :f], dtop[:, f:]), at):
            np.put_along_axis(dc, a[:, None], np.take_along_axis(dc, a[:, None], 1) + part[:, None], 1)
        dc *= c > 0
        flat = dc.reshape(-1, f)
        g["k"], g["kb"] = cols.reshape(-1, cols.shape[2]).T @ flat, flat.sum(0)
        dcols = dc @ p["k"].T
        w = p["e"].shape[1]
        de = np.zeros((n, _WINDOW, w))
        for j in range(self.reach):
            de[:, j : _WINDOW - self.reach + 1 + j] += dcols[:, :, j * (w + _BACK) : j * (w + _BACK) + w]
        return g | {"e": np.stack([np.bincount(x.ravel(), de[:, :, k].ravel(), _CODES) for k in range(w)], axis=1)}

    def epoch(self, x: np.ndarray, y: np.ndarray, train: np.ndarray, m: dict, step: int, batch: int = 64, rate: float = 3e-3) -> tuple[dict, int]:
        """Takes the weights once through the rows ``train``; gives the moments and the number of steps so far."""
        m = dict(m)
        for k in range(0, len(train), batch):
            b = train[k : k + batch]
            step += 1
            for name, g in self._gradients(x[b], y[b]).items():
                m1, m2 = m[name] = 0.9 * m[name][0] + 0.1 * g, 0.999 * m[name][1] + 0.001 * g * g
                self.p[name] = self.p[name] - rate * (m1 / (1 - 0.9**step)) / (np.sqrt(m2 / (1 - 0.999**step)) + 1e-8)
        return m, step

    def losses(self, x: np.ndarray, y: np.ndarray) -> np.ndarray:
        """Summed loss under each scale of ``_SCALES``."""
        z = self.logits(x)
        return np.array([np.sum(np.logaddexp(0, a * z + b) - y * (a * z + b)) for a, b in _SCALES])

    def fit(self, x: np.ndarray, y: np.ndarray, rounds: int = 10, batch: int = 64, rate: float = 3e-3, recall: float = 0.99) -> "Network":
        """Trains on four fifths; half of the rest sets the calibration, the other half the threshold.

        The threshold is the highest at which the share ``recall`` of the known findings is kept.
        """
        rng = np.random.default_rng(5)
        order = rng.permutation(len(x))
        check, bound, train = order[: len(order) // 10], order[len(order) // 10 : len(order) // 5], order[len(order) // 5 :]
        m = {k: (np.zeros_like(v), np.zeros_like(v)) for k, v in self.p.items()}
        step = 0
        for _ in range(rounds):
            train = rng.permutation(train)
            m, step = self.epoch(x, y, train, m, step, batch, rate)
        self.slope, self.offset = _SCALES[int(np.argmin(self.losses(x[check], y[check])))]
        known = np.sort(self.probability(x[bound][y[bound] > 0]))
        # rounded down: the finding that sets it stays above whatever batch it is judged in
        self.threshold = math.floor(1e4 * known[int((1 - recall) * len(known))]) / 1e4 if len(known) else 1.0
        return self


_LOW, _UP, _DIG = "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "0123456789"


def made_examples(seed: int = 11, each: int = 150, secret_shapes: tuple[str, ...] | None = None) -> list[tuple[str, int, int, int]]:
    """Labelled examples (text, start, end, label) made by rule: findings of the rules, secrets that the rules miss, and what looks like them.

    So a model exists for tables without findings, and it learns shapes that no rule names. ``secret_shapes`` keeps only
    some of the secrets: a test trains without those that it asks for.
    """
    rng = np.random.default_rng(seed)
    draw = lambda alphabet, lo, hi=None: "".join(rng.choice(list(alphabet), int(rng.integers(lo, (hi or lo) + 1))))
    word = lambda lo=2, hi=16: draw(_LOW, lo, hi)
    some = lambda *xs: str(rng.choice(xs))
    alnum, url_safe = _LOW + _UP + _DIG, _LOW + _UP + _DIG + "-_"
    secrets = {
        "assign": lambda: draw(alnum, 12, 40),
        "access": lambda: "AKIA" + draw(_UP + _DIG, 16),
        "hex": lambda: draw("0123456789abcdef", 16, 64),
        "prefixed": lambda: word(2, 4) + "_" + draw(alnum, 24, 36),
        "two_prefixes": lambda: f"{word(2, 4)}_{word(4, 5)}_{draw(alnum, 16, 32)}",
        "dashed": lambda: word(3, 6) + "-" + draw(alnum, 20, 32),
        "parts": lambda: ".".join(draw(url_safe, lo, hi) for lo, hi in ((18, 36), (30, 60), (24, 43))),
        "base64": lambda: draw(alnum + "+/", 24, 44) + some("", "=", "=="),
        "letters": lambda: draw(_LOW + _UP, 18, 36),
        "capitals": lambda: draw(_UP + _DIG, 20, 32),
        "groups": lambda: "-".join(draw(_UP + _DIG, 5) for _ in range(5)),
        "phrase": lambda: "".join(word(4, 8).capitalize() for _ in range(4)),
    }
    lookalikes = {
        "mail": lambda: f"{word()}.{draw(_DIG, 2)}@{word()}{draw(_DIG, 1)}.example.com",
        "address": lambda: ".".join(str(rng.integers(0, 256)) for _ in range(4)),
        "phone": lambda: f"({draw(_DIG, 3)}) {draw(_DIG, 3)}-{draw(_DIG, 4)}",
        "date": lambda: f"{rng.integers(1900, 2100)}-{rng.integers(10, 13)}-{rng.integers(10, 29)}",
        "number": lambda: draw(_DIG, 8, 16),
        "camel": lambda: word(3, 8) + "".join(word(3, 8).capitalize() for _ in range(int(rng.integers(1, 3)))),
        "snake": lambda: "_".join(word(3, 8) for _ in range(int(rng.integers(2, 5)))),
        "constant": lambda: "_".join(draw(_UP, 3, 8) for _ in range(int(rng.integers(2, 4)))),
        "path": lambda: "/".join(word(2, 9) for _ in range(int(rng.integers(2, 6)))) + some("", ".html", ".txt", f"/{draw(_DIG, 1, 4)}"),
        "version": lambda: f"{word(3, 8)}-{draw(_DIG, 1, 2)}.{draw(_DIG, 1, 2)}.{draw(_DIG, 1, 2)}",
        "code": lambda: f"{draw(_UP, 2, 3)}-{draw(_DIG, 4, 6)}",
        "long_word": lambda: word(12, 30),
        "line": lambda: some("=", "-", "_") * int(rng.integers(8, 40)),
        "again": lambda: (draw(alnum, 1, 4) * 120)[: int(rng.integers(25, 120))],
    }
    named = ["password=", "token: ", 'secret = "', "api_key="]
    labels = ["", "", "pwd: ", "pass ", "key=", "Bearer ", "auth: ", "credentials "]
    out, plain = [], []
    for _ in range(each):
        for shape, make in secrets.items():
            if secret_shapes is not None and shape not in secret_shapes:
                continue
            lead = some(*named) if shape == "assign" else "" if shape in ("access", "hex") else some("pwd: ", "pass: ", "login=") if shape == "phrase" else some(*labels)
            head, body = " ".join(word() for _ in range(4)) + " " + lead, make()
            out.append((head + body + " " + " ".join(word() for _ in range(3)), len(head), len(head) + len(body), 1))
        for shape, make in lookalikes.items():
            before, after = f"{word()} {word()}{some('', '', ':', ' =')} ", f"{some('', '', '.', ',')} {word()} {word()}"
            if shape in ("line", "again"):  # these may be a whole text
                before, after = (x if rng.random() < 0.5 else "" for x in (before, after))
            plain.append(before + make() + after)
    return out + [(text, s, e, 0) for text, (_, runs) in zip(plain, _candidates(plain)) for run in runs for s, e in (run, *pieces(*run))]


def _findings(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Labelled windows of a sample's candidates and findings, with a hash to draw from them; a window comes once from a task."""
    seen: set[bytes] = set()
    for batch in short_batches(batches, lambda b: b.column(0)):
        data, labels, spots = [], [], []
        texts = batch.column(0).to_pylist()
        for text, (codes, runs) in zip(texts, _candidates(texts)):
            rules = rule_spans(text)
            spans = {(s, e): 1 for s, _, e in rules}
            spans |= {c: 0 for c, alone in _apart(runs, rules) if alone}
            for (s, e), label in spans.items():
                w = _view(codes, s, e).tobytes()
                if (key := w + bytes([label])) in seen:
                    continue
                if len(seen) < _MOST_SEEN:
                    seen.add(key)
                data.append(w)
                labels.append(label)
                spots.append(hashlib.md5(w).hexdigest())
        yield pa.RecordBatch.from_arrays([pa.array(data, pa.binary()), pa.array(labels, pa.int32()), pa.array(spots, pa.string())], ["x", "y", "spot"])


def fit(docs: DataFrame, text_col: str = "text", *, sample_docs: int | None = None, sample_findings: int | None = None, recall: float = 0.99) -> Network:
    """A network trained on the rules' findings, on candidates they leave, and on examples made by rule.

    All distinct windows of all texts are learned from, and calibration and threshold come from all that are kept for them; up to ``_SHARD`` windows are trained on in one place, more of them
    where they lie (``_train``). Null texts have none, an empty table trains on the made examples alone. Only where ``sample_docs`` or ``sample_findings`` say so, texts are drawn by their hash, about that many rows' share of
    them, or at most so many distinct windows of each label, however often one is repeated.
    """
    t = F.col(text_col).cast("string")
    if sample_docs is not None:
        docs = docs.where(F.pmod(F.xxhash64(t), F.lit(1 << 20)) < int(min(1.0, sample_docs / max(1, docs.count())) * (1 << 20)))
    texts = docs.where(t.rlike("[0-9+/=_:]|[a-z][A-Z]|[a-f]{16}|[A-Za-z]{25}|(?i:password|passwd|secret|token|api_?key)")).select(t.alias("text"))
    found = Scratch(docs.sparkSession, "secrets").save(texts.mapInArrow(_findings, "x binary, y int, spot string").distinct(), "findings")
    made = made_examples()
    x, y = np.stack([window(text, s, e) for text, s, e, _ in made]), np.array([m[3] for m in made], float)
    n = found.count()
    if sample_findings is None and n > _SHARD:
        return _train(found, n, x, y, recall)
    got = [r for label in (0, 1) for r in found.where(F.col("y") == label).orderBy("spot").limit(sample_findings or _SHARD).collect()]
    own = [np.frombuffer(r["x"], np.uint8).astype(np.int64) for r in got]
    return Network().fit(np.stack([*own, *x]), np.concatenate([np.array([r["y"] for r in got], float), y]), recall=recall)


#: Windows that are trained on in one place, and the most places there are.
_SHARD, _MOST_SHARDS = 3000, 64


def _train(found: DataFrame, n: int, made_x: np.ndarray, made_y: np.ndarray, recall: float, rounds: int = 10) -> Network:
    """A network trained on all ``n`` windows ``(x, y, spot)`` where they lie, in shards by a hash.

    In every round each shard, which has the made examples too, takes the weights once through its windows, and the shards' weights and moments are averaged; only those reach the driver. As in ``Network.fit``
    four fifths are trained on; of the rest one half gives sums of losses for the calibration, the other counts of probabilities in steps of 1e-4 for the threshold.
    """
    shards = min(_MOST_SHARDS, -(-n // _SHARD))
    dealt = found.select("x", "y", "spot", F.pmod(F.xxhash64("spot"), F.lit(shards)).alias("shard")).repartition(shards, "shard")
    made = found.sparkSession.sparkContext.broadcast((made_x.astype(np.uint8), made_y))

    def on_shards(work) -> list[np.ndarray]:
        """What ``work`` gives for the windows, labels and generator of each shard, in the order of shards."""

        def one(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
            shard = key[0].as_py()
            table = table.sort_by([("spot", "ascending"), ("y", "ascending")])
            own, (mx, my) = np.frombuffer(b"".join(table.column("x").to_pylist()), np.uint8).reshape(-1, _WINDOW), made.value
            again = max(1, round(len(own) / _SHARD))  # as large a share of every shard
            x, y = np.concatenate([own, *[mx] * again]), np.concatenate([table.column("y").to_numpy().astype(float), *[my] * again])
            return pa.table({"shard": pa.array([shard], pa.int64()), "v": pa.array([work(x, y, np.random.default_rng((5, shard)).permutation(len(x)), shard)], pa.list_(pa.float64()))})

        rows = dealt.groupBy("shard").applyInArrow(one, "shard long, v array<double>").collect()
        return [np.array(r["v"]) for r in sorted(rows, key=lambda r: r["shard"])]

    network, step = Network(), 0
    names = list(network.p)
    m = {k: (np.zeros_like(v), np.zeros_like(v)) for k, v in network.p.items()}
    for k in range(rounds):

        def epoch(x, y, order, shard, network=network, m=m, step=step, k=k):
            train = np.random.default_rng((6, shard, k)).permutation(order[len(order) // 5 :])
            m, step = network.epoch(x.astype(np.int64), y, train, m, step)
            return np.concatenate([np.concatenate([network.p[c].ravel(), *(z.ravel() for z in m[c])]) for c in names] + [np.array([step])])

        flat, at = np.mean(on_shards(epoch), axis=0), 0
        network, m, step = Network(), {}, int(flat[-1])
        for c in names:
            shape, size = network.p[c].shape, network.p[c].size
            parts = [flat[at + j * size : at + (j + 1) * size].reshape(shape) for j in range(3)]
            network.p[c], m[c], at = parts[0], (parts[1], parts[2]), at + 3 * size
    loss = np.sum(on_shards(lambda x, y, order, _: network.losses(x[order[: len(order) // 10]].astype(np.int64), y[order[: len(order) // 10]])), axis=0)
    network.slope, network.offset = _SCALES[int(np.argmin(loss))]

    def counts(x, y, order, _):
        bound = order[len(order) // 10 : len(order) // 5]
        return np.bincount(np.floor(1e4 * network.probability(x[bound][y[bound] > 0].astype(np.int64))).astype(int), minlength=10_001).astype(float)

    known = np.cumsum(np.sum(on_shards(counts), axis=0))
    network.threshold = int(np.searchsorted(known, int((1 - recall) * known[-1]), side="right")) / 1e4 if known[-1] else 1.0
    return network


def find_all(texts: list[str], network: Network | None) -> list[tuple[list[Span], list[Span]]]:
    """Of each text the rules' spans, and all spans: those and the candidates, not wholly inside one of them, that the network finds.

    Windows that many texts share are judged once.
    """
    out, asked, views = [], [], {}
    for text, (codes, runs) in zip(texts, _candidates(texts)):
        rules = rule_spans(text)
        out.append((rules, rules))
        for c, _ in _apart(runs, rules) if network else []:
            seen = [views.setdefault(_view(codes, *p).tobytes(), len(views)) for p in (c, *pieces(*c))]
            asked.append((len(out) - 1, c, seen))
    if views:
        sure = network.probability(np.frombuffer(b"".join(views), np.uint8).reshape(-1, _WINDOW).astype(np.int64)) >= network.threshold
        more: dict[int, list[Span]] = {}
        for k, (start, end), seen in asked:
            if sure[seen].any():
                more.setdefault(k, []).append((start, 3, end))
        for k, spans in more.items():
            out[k] = out[k][0], sorted(out[k][0] + spans)
    return out


def find_spans(text: str, network: Network | None) -> tuple[list[Span], list[Span]]:
    """``find_all`` of one text."""
    return find_all([text], network)[0]


def pieces(start: int, end: int) -> list[tuple[int, int]]:
    """The overlapping windows that cover a run longer than one; none of a shorter run."""
    if end - start <= _SPAN:
        return []
    return [(k, k + _SPAN) for k in [*range(start, end - _SPAN, _SPAN // 2), end - _SPAN]]


def _join(spans: list[Span]) -> str:
    return ",".join(f"{KINDS[k]}:{s}:{e}" for s, k, e in spans)


def _scan(batches: Iterator[pa.RecordBatch], network: Network | None) -> Iterator[pa.RecordBatch]:
    for batch in short_batches(batches):
        rules, spans = zip(*find_all([t or "" for t in batch.column(1).to_pylist()], network))
        counts = [pa.array([sum(k == kind for _, k, _ in r) for r in rules], pa.int64()) for kind in range(3)]
        digest = [hashlib.sha256(_join(r).encode()).hexdigest() for r in rules]
        yield pa.RecordBatch.from_arrays([batch.column(0), *counts, pa.array(digest, pa.string()), pa.array([_join(s) for s in spans], pa.string())], ["id", "n_assign", "n_access", "n_hex", "base_sha256", "spans"])


def scan(docs: DataFrame, network: Network | None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row ``(id, n_assign, n_access, n_hex, base_sha256, spans)`` per row of ``docs``.

    ``spans`` lists kind:start:end of all findings by start, then kind, in code points with the end exclusive; the counts
    and the digest cover the rules' findings alone. The network judges every run of token characters that ``candidates`` gives. Whole texts are read; null text counts as empty. Repeated
    rows and null ids keep their rows; an empty table gives an empty result; other columns are ignored.
    """
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
    return rows.mapInArrow(lambda it: _scan(it, network), "id long, n_assign long, n_access long, n_hex long, base_sha256 string, spans string")


def _mask(batches: Iterator[pa.RecordBatch], network: Network | None, place: int, mask: str) -> Iterator[pa.RecordBatch]:
    for batch in short_batches(batches, lambda b: b.column(0).field(place)):
        rows = batch.column(0)
        columns, out = rows.flatten(), []
        texts = columns[place].to_pylist()
        for text, (_, every) in zip(texts, find_all([t or "" for t in texts], network)):
            if spans := merged(every):
                ends = [0, *(e for _, _, e in spans)]
                text = "".join(text[a:s] + mask for a, (s, _, _) in zip(ends, spans)) + text[ends[-1] :]
            out.append(text)
        columns[place] = pa.array(out, columns[place].type)
        yield pa.RecordBatch.from_arrays([pa.StructArray.from_arrays(columns, fields=list(rows.type))], ["row"])


def merged(spans: list[Span]) -> list[Span]:
    """Overlapping spans as one."""
    out: list[Span] = []
    for s, k, e in spans:
        if out and s < out[-1][2]:
            out[-1] = (out[-1][0], out[-1][1], max(e, out[-1][2]))
        else:
            out.append((s, k, e))
    return out


def mask_secrets(docs: DataFrame, network: Network | None, text_col: str = "text", mask: str = "[SECRET]") -> DataFrame:
    """The rows of ``docs`` with every finding in the text replaced; rows without findings, and null texts, stay as they are.

    Whole texts are scanned; repeated rows and null ids stay; columns may have any names; an empty table gives an empty result.
    """
    rows, place = docs.select(F.struct("*").alias("row")), docs.columns.index(text_col)
    return rows.mapInArrow(lambda it: _mask(it, network, place, mask), rows.schema).select("row.*")
