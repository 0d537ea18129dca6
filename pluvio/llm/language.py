"""Language identification by a bidirectional gated recurrent network over bytes.

A text is cut at white space, and pieces over ``PIECE`` bytes every ``PIECE``
bytes, so nothing is left out. The network reads the bytes of a piece forwards
and backwards and gives every position a distribution over the languages. A
document's log probabilities are the means over the positions of each piece,
summed over its pieces. A piece's positions depend on the piece alone, so a task
runs the network once for each piece it has not met and remembers the sums; the
memory is emptied when it holds ``MEMORY`` pieces.

Training (numpy, back-propagation through time, Adam) uses a bounded sample of
labelled rows: about ``SAMPLE`` documents per language with at most ``LONGEST``
bytes each, from the ``LANGUAGES`` most frequent languages, and ``TOKENS`` pieces
per language from them. Every labelled document has the same chance.

The result is ``und`` with score 0 for a null text, a text without letters, and
for every text if no labelled row could be learned from. Ties go to the first
language by name. Repeated rows get the same answer each.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pluvio.llm.common import col, with_values

PIECE = 32
HIDDEN = 16
SAMPLE = 400
LONGEST = 1 << 16
LANGUAGES = 256
TOKENS = 12_000
EPOCHS = 3
MEMORY = 1_000_000


def pieces(text: str | None) -> list[bytes]:
    found = (text or "").encode("utf-8", "replace").split()
    if all(len(piece) <= PIECE for piece in found):
        return found
    return [piece[i : i + PIECE] for piece in found for i in range(0, len(piece), PIECE)]


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 * np.tanh(0.5 * x) + 0.5


class Reader:
    """A gated recurrent unit that reads bytes in one direction."""

    def __init__(self, random: np.random.Generator, hidden: int):
        self.E = random.normal(0, 0.3, (256, 3 * hidden)).astype(np.float32)
        self.U = random.normal(0, 1 / np.sqrt(hidden), (hidden, 3 * hidden)).astype(np.float32)

    def forward(self, x: np.ndarray, keep: bool = False):
        """States after each position of ``x`` (pieces by positions): positions, pieces, hidden."""
        size = self.U.shape[0]
        h = np.zeros((len(x), size), np.float32)
        states, steps = [], []
        for t in range(x.shape[1]):
            inner, outer = h @ self.U, self.E[x[:, t]]
            gates = _sigmoid(outer[:, : 2 * size] + inner[:, : 2 * size])
            z, r = gates[:, :size], gates[:, size:]
            n = np.tanh(outer[:, 2 * size :] + r * inner[:, 2 * size :])
            if keep:
                steps.append((h, z, r, n, inner[:, 2 * size :]))
            h = n + z * (h - n)
            states.append(h)
        return np.stack(states), steps

    def backward(self, x: np.ndarray, steps: list, upon: np.ndarray) -> dict[str, np.ndarray]:
        """Gradients, given those upon the states."""
        size = self.U.shape[0]
        dE, dU = np.zeros_like(self.E), np.zeros_like(self.U)
        dh = np.zeros_like(upon[0])
        for t in range(x.shape[1] - 1, -1, -1):
            h, z, r, n, inner = steps[t]
            dh = dh + upon[t]
            dn = dh * (1 - z) * (1 - n * n)
            dz = dh * (h - n) * z * (1 - z)
            dr = dn * inner * r * (1 - r)
            outer = np.hstack([dz, dr, dn])
            into = np.hstack([dz, dr, dn * r])
            np.add.at(dE, x[:, t], outer)
            dU += h.T @ into
            dh = dh * z + into @ self.U.T
        return {"E": dE, "U": dU}


class Network:
    def __init__(self, languages: list[str], seed: int = 7, hidden: int = HIDDEN):
        random = np.random.default_rng(seed)
        self.languages = languages
        self.there, self.back = Reader(random, hidden), Reader(random, hidden)
        self.V = random.normal(0, 0.1, (2 * hidden, len(languages))).astype(np.float32)
        self.c = np.zeros(len(languages), np.float32)

    def _states(self, x: np.ndarray, keep: bool = False):
        there, a = self.there.forward(x, keep)
        back, b = self.back.forward(x[:, ::-1], keep)
        return np.concatenate([there, back[::-1]], 2), a, b

    def positions(self, x: np.ndarray) -> np.ndarray:
        """Log probabilities for every position: positions, pieces, languages."""
        logits = self._states(x)[0] @ self.V + self.c
        logits -= logits.max(2, keepdims=True)
        return logits - np.log(np.exp(logits).sum(2, keepdims=True))

    def gradients(self, x: np.ndarray, y: np.ndarray) -> tuple[float, dict]:
        """Mean cross entropy over all positions and its gradients."""
        states, a, b = self._states(x, keep=True)
        logits = states @ self.V + self.c
        logits -= logits.max(2, keepdims=True)
        p = np.exp(logits)
        p /= p.sum(2, keepdims=True)
        many = p.shape[0] * p.shape[1]
        loss = -np.log(p[:, np.arange(len(y)), y] + 1e-12).mean()
        p[:, np.arange(len(y)), y] -= 1
        p /= many
        flat, upon = states.reshape(many, -1), p @ self.V.T
        size = self.there.U.shape[0]
        there = self.there.backward(x, a, upon[:, :, :size])
        back = self.back.backward(x[:, ::-1], b, upon[::-1, :, size:])
        return float(loss), {"V": flat.T @ p.reshape(many, -1), "c": p.sum((0, 1)), **{f"there.{k}": v for k, v in there.items()}, **{f"back.{k}": v for k, v in back.items()}}

    def parameters(self) -> dict[str, np.ndarray]:
        return {"V": self.V, "c": self.c, "there.E": self.there.E, "there.U": self.there.U, "back.E": self.back.E, "back.U": self.back.U}

    def train(self, by_language: list[list[bytes]], epochs: int = EPOCHS, batch: int = 256, rate: float = 0.01, seed: int = 11) -> None:
        random = np.random.default_rng(seed)
        by_length: dict[int, list[tuple[bytes, int]]] = {}
        for y, found in enumerate(by_language):
            for piece in found:
                by_length.setdefault(len(piece), []).append((piece, y))
        sets = [(np.frombuffer(b"".join(p for p, _ in part), np.uint8).reshape(len(part), n), np.array([y for _, y in part])) for n, part in sorted(by_length.items())]
        parameters = self.parameters()
        first = {k: np.zeros_like(v) for k, v in parameters.items()}
        second = {k: np.zeros_like(v) for k, v in parameters.items()}
        step = 0
        for epoch in range(epochs):
            work = [(i, rows) for i, (x, _) in enumerate(sets) for rows in np.array_split(random.permutation(len(x)), -(-len(x) // batch))]
            for j in random.permutation(len(work)):
                x, y = sets[work[j][0]][0][work[j][1]], sets[work[j][0]][1][work[j][1]]
                _, gradients = self.gradients(x, y)
                step += 1
                for k, g in gradients.items():
                    g *= min(1.0, 5.0 / (np.sqrt((g * g).sum()) + 1e-9))
                    first[k] += 0.1 * (g - first[k])
                    second[k] += 0.001 * (g * g - second[k])
                    parameters[k] -= rate / (1 + epoch) * (first[k] / (1 - 0.9**step)) / (np.sqrt(second[k] / (1 - 0.999**step)) + 1e-8)

    def label(self, text: str) -> list[tuple[bytes, list[str]]]:
        """Every piece of the text with the language of each of its bytes."""
        found = []
        for piece in pieces(text):
            best = self.positions(np.frombuffer(piece, np.uint8)[None])[:, 0].argmax(1)
            found.append((piece, [self.languages[i] for i in best]))
        return found


class Pooler:
    """Pools documents, remembering the pooled positions of the pieces it has met."""

    def __init__(self, network: Network):
        self.network = network
        self.forget()

    def forget(self) -> None:
        self.known: dict[bytes, int] = {}
        self.sums = np.zeros((1024, len(self.network.languages)), np.float32)

    def learn(self, new: set[bytes]) -> None:
        by_length: dict[int, list[bytes]] = {}
        for piece in new:
            by_length.setdefault(len(piece), []).append(piece)
        while len(self.known) + len(new) > len(self.sums):
            self.sums = np.vstack([self.sums, np.zeros_like(self.sums)])
        for length, found in by_length.items():
            for i in range(0, len(found), 1024):
                part = found[i : i + 1024]
                x = np.frombuffer(b"".join(part), np.uint8).reshape(len(part), length)
                first = len(self.known)
                self.sums[first : first + len(part)] = self.network.positions(x).mean(0)
                self.known.update(zip(part, range(first, first + len(part))))

    def predict(self, texts: list[str | None]) -> list[dict]:
        if not self.network.languages:
            return [{"lang_pred": "und", "score": 0.0} for _ in texts]
        if len(self.known) > MEMORY:
            self.forget()
        cut = [pieces(text) for text in texts]
        new = set().union(*cut).difference(self.known) if cut else set()
        self.learn(new)
        made = []
        for text, found in zip(texts, cut):
            if not text or not any(map(str.isalpha, text)):
                made.append({"lang_pred": "und", "score": 0.0})
                continue
            total = self.sums[list(map(self.known.__getitem__, found))].sum(0, dtype=np.float64)
            best = int(total.argmax())
            made.append({"lang_pred": self.network.languages[best], "score": float(1 / np.exp(total - total[best]).sum())})
        return made


def fit(docs: DataFrame, learn: Column, text_col: str = "text", lang_col: str = "lang", id_col: str = "doc_id") -> Network:
    """Trains on a bounded sample of the rows where ``learn`` holds and the language is known."""
    usable = docs.where(learn & col(lang_col).isNotNull() & col(text_col).isNotNull()).select(col(lang_col).alias("lang"), col(id_col).alias("id"), col(text_col).alias("text"))
    short = usable.where(F.octet_length("text") <= LONGEST)
    counts = {r["lang"]: r["n"] for r in short.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), "lang").limit(LANGUAGES).collect()}
    if not counts:
        return Network([])
    parts, draw = 1 << 30, F.pmod(F.xxhash64(F.lit(3), "id"), F.lit(1 << 30))
    limits = F.create_map(*[F.lit(x) for lang, n in counts.items() for x in (lang, min(parts, SAMPLE * parts // n))])
    sample = short.where(draw < F.coalesce(limits[F.col("lang")], F.lit(0))).select("lang", "text", draw.alias("draw"))
    # Half as many again as expected is far beyond chance; repeated ids could bring more.
    rows = sample.orderBy("draw", "lang", "text").limit(2 * SAMPLE * len(counts)).collect()
    languages = sorted({r["lang"] for r in rows})
    random = np.random.default_rng(5)
    by_language = []
    for lang in languages:
        found = [piece for r in rows if r["lang"] == lang for piece in pieces(r["text"])]
        chosen = random.permutation(len(found))[:TOKENS]
        by_language.append([found[i] for i in chosen])
    network = Network(languages)
    network.train(by_language)
    return network


#: The worker's pooler; its memory serves all tasks of one network.
_POOLERS: dict[str, Pooler] = {}


def predict(docs: DataFrame, network: Network, text_col: str = "text", as_col: str = "language") -> DataFrame:
    """The documents with ``as_col``: the language and its probability."""
    shipped = docs.sparkSession.sparkContext.broadcast(network)  # some 50 kB, fixed by HIDDEN and LANGUAGES

    def run(texts: list) -> list[dict]:
        found = _POOLERS.get("last")
        if found is None or found.network is not shipped.value:
            found = _POOLERS["last"] = Pooler(shipped.value)
        return found.predict(texts)

    kind = pa.struct([("lang_pred", pa.string()), ("score", pa.float64())])
    return with_values(docs, text_col, as_col, "struct<lang_pred:string, score:double>", kind, run)
