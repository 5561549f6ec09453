"""Secret scans with a character convolutional network in numpy.

One pass over the texts finds the base spans (assign, access, hex) and the candidates: runs of 12 or more token
characters that hold a letter and a digit, with the text around them.  A small network (character embedding,
one convolution, maximum over positions, logistic output) rates overlapping windows over the whole run; a run counts
as a secret if any of its windows does.  It is trained on labelled findings: what the base patterns
matched is positive, the windows of other candidates and long plain words are negative.  Two networks are fitted on halves of the findings;
each is calibrated on the half it has not seen, where its threshold must keep the wanted recall, and rates that half.  Candidates above it that no base span touches
are added as kind ``model``; base spans stay as they are.

Bounds: the network is fitted on at most ``TRAIN_ROWS`` findings of each class, those with the smallest hashes; every
candidate of every text is scored.

Cases: null or empty text has no spans; repeated rows are scanned alike; with fewer than ``LEAST_ROWS`` findings
of a class there is no model and only base spans are returned; extra columns are ignored; an empty table
gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import cut_lineage
from .text import table

KINDS = ("assign", "access", "hex", "model")
SHORTEST = 12
BEFORE, TOKEN, AFTER = 24, 40, 8   # characters of the window the network sees
TRAIN_ROWS = 2000
LEAST_ROWS = 30
RECALL = 0.98
FLOOR = 0.5                        # no threshold below this calibrated chance, unless the recall needs it


def _letters(word: str) -> str:
    return "".join(f"[{c.upper()}{c}]" if c.isalpha() else c for c in word)


def patterns():
    import re

    names = "|".join(_letters(w) for w in ("password", "passwd", "secret", "token", "api_?key"))
    return (re.compile(rf"""({names})["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""), re.compile(r"AKIA[A-Z0-9]+"),
            re.compile(r"[0-9a-f]{24,}"), re.compile(r"[A-Za-z0-9+/_=.-]{%d,}" % SHORTEST), re.compile(r"[0-9]"),
            re.compile(r"[A-Za-z]"))


def base_spans(text: str, compiled) -> list[tuple[int, int, int]]:
    """(start, kind number, end) of the base spans, sorted."""
    assign, access, hexes = compiled[:3]
    found = []
    low = text.lower()
    if any(w in low for w in ("password", "passwd", "secret", "token", "api_key", "apikey")):
        found += [(m.start(), 0, m.end()) for m in assign.finditer(text) if m.end(2) - m.start(2) >= 6]
    if "AKIA" in text:
        found += [(m.start(), 1, m.end()) for m in access.finditer(text) if m.end() - m.start() >= 20]
    found += [(m.start(), 2, m.end()) for m in hexes.finditer(text)]
    return sorted(found)


def window(text: str, start: int, end: int) -> str:
    """The fixed-width view of a candidate: text before it (right-aligned), its first characters, text after."""
    before = text[max(0, start - BEFORE) : start].rjust(BEFORE)
    return before + text[start : min(end, start + TOKEN)].ljust(TOKEN) + text[end : end + AFTER].ljust(AFTER)


def windows(text: str, start: int, end: int) -> list[str]:
    """Views over a whole candidate: that of its start, one every half token, the last up to its end, and one from the
    start of each of its parts of SHORTEST or more letters and digits.  What is before an inner view is of the same run,
    so it is left blank, as for tokens alone."""
    import re

    starts = {*range(start + TOKEN // 2, end - TOKEN, TOKEN // 2), end - TOKEN} if end - start > TOKEN else set()
    parts = re.compile(r"[A-Za-z0-9]{%d,}" % SHORTEST).finditer(text, start, end)
    starts |= {m.start() for m in parts if m.start() > start}
    return [window(text, start, end)] + [" " * BEFORE + window(text, a, min(end, a + TOKEN))[BEFORE:] for a in sorted(starts)]


SCANNED = T.StructType([
    T.StructField("base", T.ArrayType(T.StructType([T.StructField("start", T.LongType()), T.StructField("kind", T.IntegerType()),
                                                    T.StructField("end", T.LongType())]))),
    T.StructField("candidates", T.ArrayType(T.StructType([
        T.StructField("start", T.LongType()), T.StructField("end", T.LongType()), T.StructField("views", T.ArrayType(T.StringType()))]))),
    T.StructField("findings", T.ArrayType(T.StructType([T.StructField("label", T.IntegerType()), T.StructField("view", T.StringType())]))),
])


def _scan():
    def run(batches):
        import re

        import pandas as pd

        compiled = patterns()
        runs, digit, letter = compiled[3:]
        plain = re.compile(r"[A-Za-z]{%d,}" % SHORTEST)
        for pdf in batches:
            base, candidates, findings = [], [], []
            for text in pdf["_text"]:
                text = text or ""
                spans = base_spans(text, compiled)
                free, found = [], []
                if digit.search(text):
                    for m in runs.finditer(text):
                        a, b = m.span()
                        if digit.search(text, a, b) and letter.search(text, a, b) and not any(s < b and a < e for s, _, e in spans):
                            free.append({"start": a, "end": b, "views": windows(text, a, b)})
                for s, kind, e in spans:
                    at = s if kind else max(s, e - len(re.search(r"[A-Za-z0-9+/_.=-]*$", text[s:e])[0]))
                    view = window(text, at, e)
                    found.append({"label": 1, "view": view})
                    found.append({"label": 1, "view": " " * BEFORE + view[BEFORE:]})  # the token alone
                found += [{"label": 0, "view": view} for c in free for view in c["views"]]
                if m := plain.search(text):
                    found.append({"label": 0, "view": window(text, *m.span())})
                base.append([{"start": s, "kind": k, "end": e} for s, k, e in spans])
                candidates.append(free)
                findings.append(found)
            yield pd.DataFrame({"doc_id": pdf["doc_id"], "base": base, "candidates": candidates, "findings": findings})

    return run


def encode(views):
    """Character classes of views: printable ASCII by code, 95 for other characters."""
    import numpy as np

    width = BEFORE + TOKEN + AFTER
    x = np.array([[ord(c) for c in v[:width].ljust(width)] for v in views], np.int64).reshape(-1, width) - 32
    return np.where((x < 0) | (x > 94), 95, x).astype(np.int64)


class CharNet:
    """Embedding of 96 character classes, one convolution with ReLU, maximum over positions, one logistic output."""

    def __init__(self, size: int = 8, width: int = 5, filters: int = 24, seed: int = 7):
        import numpy as np

        rng = np.random.default_rng(seed)
        self.width = width
        self.p = {"emb": rng.normal(0, 0.3, (96, size)), "conv": rng.normal(0, 0.2, (width * size, filters)),
                  "bias": np.zeros(filters), "out": rng.normal(0, 0.3, filters), "one": np.zeros(1)}
        self.calibration = (1.0, 0.0)
        self.threshold = 1.0

    def forward(self, x):
        import numpy as np

        e = self.p["emb"][x]
        n = x.shape[1] - self.width + 1
        cols = np.concatenate([e[:, k : k + n] for k in range(self.width)], axis=2)
        z = cols @ self.p["conv"] + self.p["bias"]
        best = z.argmax(1)
        top = np.take_along_axis(z, best[:, None], 1)[:, 0]
        hidden = np.maximum(top, 0)
        return hidden @ self.p["out"] + self.p["one"][0], (cols, best, top, hidden)

    def fit(self, x, y, steps: int = 600, batch: int = 64, rate: float = 5e-3, seed: int = 11):
        import numpy as np

        rng = np.random.default_rng(seed)
        m = {k: np.zeros_like(v) for k, v in self.p.items()}
        v = {k: np.zeros_like(w) for k, w in self.p.items()}
        size = self.p["emb"].shape[1]
        for t in range(1, steps + 1):
            pick = rng.integers(0, len(x), batch)
            logit, (cols, best, top, hidden) = self.forward(x[pick])
            d = (1 / (1 + np.exp(-np.clip(logit, -40, 40))) - y[pick]) / batch
            g = {"out": hidden.T @ d, "one": np.array([d.sum()])}
            dh = d[:, None] * self.p["out"] * (top > 0)
            taken = cols[np.arange(batch)[:, None], best]                       # batch, filters, width * size
            g["conv"], g["bias"] = np.einsum("nf,nfc->cf", dh, taken), dh.sum(0)
            back = dh[:, :, None] * self.p["conv"].T                            # batch, filters, width * size
            g["emb"] = np.zeros_like(self.p["emb"])
            for k in range(self.width):
                chars = np.take_along_axis(x[pick], best + k, 1)
                np.add.at(g["emb"], chars, back[:, :, k * size : (k + 1) * size])
            for k in self.p:
                m[k] = 0.9 * m[k] + 0.1 * g[k]
                v[k] = 0.999 * v[k] + 0.001 * g[k] ** 2
                self.p[k] = self.p[k] - rate * (m[k] / (1 - 0.9**t)) / (np.sqrt(v[k] / (1 - 0.999**t)) + 1e-8)
        return self

    def calibrate(self, x, y, recall: float = RECALL):
        """Slope and offset of the logit that fit held-back findings, then the threshold: halfway from the highest
        one that keeps the recall to the best-rated negative below it (or the floor), so new findings have room; where
        the recall needs a threshold below the floor, it is that highest one."""
        import numpy as np

        logit = self.forward(x)[0]
        a, b = 1.0, 0.0
        soft = np.where(y == 1, (y.sum() + 1) / (y.sum() + 2), 1 / ((y == 0).sum() + 2))
        for _ in range(300):
            p = 1 / (1 + np.exp(-np.clip(a * logit + b, -40, 40)))
            a, b = a - 0.05 * ((p - soft) * logit).mean(), b - 0.5 * (p - soft).mean()
        self.calibration = (float(a), float(b))
        chance = self.chance(x)
        kept = np.sort(chance[y == 1])
        top = float(kept[int((1 - recall) * len(kept))])
        below = chance[(y == 0) & (chance < top)]
        self.threshold = min(top, (top + float(below.max(initial=FLOOR))) / 2)
        return self

    def chance(self, x):
        import numpy as np

        a, b = self.calibration
        return 1 / (1 + np.exp(-np.clip(a * self.forward(x)[0] + b, -40, 40)))


def fold(view: str) -> int:
    """Half of the findings that a view belongs to."""
    import zlib

    return zlib.crc32(view.encode()) & 1


def train(findings: DataFrame, rows: int = TRAIN_ROWS) -> list[CharNet] | None:
    """Two calibrated networks from (label, view) findings, or None where a class has too few.

    Distinct views are taken by smallest hash, at most ``rows`` of each class.  Network k is fitted on the views of the
    other half and calibrated on half k, whose candidates it rates: no candidate is rated by a network that saw it
    as a negative."""
    import numpy as np

    views, labels = [], []
    distinct = findings.groupBy("view").agg(F.max("label").alias("label"))
    for label in (1, 0):
        held = (distinct.where(F.col("label") == label).orderBy(F.xxhash64("view"), "view").limit(rows).select("view").collect())
        if len(held) < LEAST_ROWS:
            return None
        views += [r["view"] for r in held]
        labels += [label] * len(held)
    x, y, half = encode(views), np.array(labels), np.array([fold(v) for v in views])
    return [CharNet().fit(x[half != k], y[half != k]).calibrate(x[half == k], y[half == k]) for k in (0, 1)]


def accepted(nets: list[CharNet], views: list[str]) -> list[bool]:
    """Whether each view reaches the threshold of its network."""
    import numpy as np

    half, x = np.array([fold(v) for v in views]), encode(views)
    chance = [net.chance(x) >= net.threshold for net in nets]
    return np.where(half == 0, chance[0], chance[1]).tolist()


def _score(nets: list[CharNet] | None):
    def run(batches):
        import hashlib

        import pandas as pd

        for pdf in batches:
            views = [view for row in pdf["candidates"] for c in row for view in c["views"]]
            good = []
            for a in range(0, len(views) if nets else 0, 2000):
                good += accepted(nets, views[a : a + 2000])
            at, out = 0, {k: [] for k in ("n_assign", "n_access", "n_hex", "base_sha256", "spans", "n_model")}
            for base, row in zip(pdf["base"], pdf["candidates"]):
                spans = [(s["start"], s["kind"], s["end"]) for s in base]
                said = lambda spans: ",".join(f"{KINDS[k]}:{s}:{e}" for s, k, e in spans)
                more = []
                for c in row:
                    if nets and any(good[at : at + len(c["views"])]):
                        more.append((c["start"], 3, c["end"]))
                    at += len(c["views"])
                for k in range(3):
                    out["n_" + KINDS[k]].append(sum(s[1] == k for s in spans))
                out["base_sha256"].append(hashlib.sha256(said(spans).encode()).hexdigest())
                out["spans"].append(said(sorted(spans + more)))
                out["n_model"].append(len(more))
            yield pd.DataFrame({"doc_id": pdf["doc_id"], **out})

    return run


def find(docs: DataFrame, rows: int = TRAIN_ROWS) -> DataFrame:
    """doc_id, n_assign, n_access, n_hex, base_sha256, spans, n_model for every document."""
    key = T.StructField("doc_id", docs.schema["doc_id"].dataType)
    scanned = cut_lineage(docs.select("doc_id", F.col("text").alias("_text")).mapInPandas(
        _scan(), T.StructType([key, *SCANNED.fields])))
    nets = train(scanned.select(F.explode("findings").alias("f")).select("f.label", "f.view"), rows)
    schema = T.StructType([key] + [T.StructField(c, T.LongType()) for c in ("n_assign", "n_access", "n_hex")]
                          + [T.StructField("base_sha256", T.StringType()), T.StructField("spans", T.StringType()),
                             T.StructField("n_model", T.LongType())])
    return scanned.select("doc_id", "base", "candidates").mapInPandas(_score(nets), schema)


def op4_secrets(spark, sf_dir: str) -> DataFrame:
    """Secrets in every document: base spans and those the network adds."""
    return find(table(spark, sf_dir, "documents"))
