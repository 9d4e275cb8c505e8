"""A bidirectional LSTM in numpy that labels the blocks of a page as main text or not."""

from __future__ import annotations

import math
import zlib
from dataclasses import dataclass

import numpy as np

from tallyworks.llm.htmlblocks import Block

PATH_BUCKETS, LAST_BUCKETS, WORD_BUCKETS, NUMBERS = 128, 32, 32, 6
INPUTS = PATH_BUCKETS + LAST_BUCKETS + WORD_BUCKETS + NUMBERS
HIDDEN = 16
# Blocks of one page, or cells of pages side by side, whose vectors are held at once.
BLOCKS_AT_ONCE, CELLS_AT_ONCE = 4096, 40_000


class Features:
    """Vectors of blocks: hashed elements of the path, hashed words, and a few numbers."""

    def __init__(self) -> None:
        self.paths: dict[tuple, np.ndarray] = {}
        self.words: dict[str, int] = {}

    def _path(self, path: tuple[tuple[str, ...], ...]) -> np.ndarray:
        found = self.paths.get(path)
        if found is None:
            if len(self.paths) >= 20_000:
                self.paths.clear()
            found = np.zeros(PATH_BUCKETS + LAST_BUCKETS, np.float32)
            for element in path:
                for token in element:
                    found[zlib.crc32(token.encode()) % PATH_BUCKETS] = 1
            for token in path[-1] if path else ():
                found[PATH_BUCKETS + zlib.crc32(b"last " + token.encode()) % LAST_BUCKETS] = 1
            self.paths[path] = found
        return found

    def _word(self, word: str) -> int:
        found = self.words.get(word)
        if found is None:
            if len(self.words) >= 200_000:
                self.words.clear()
            found = self.words[word] = zlib.crc32(word.lower().encode()) % WORD_BUCKETS
        return found

    def of(self, blocks: list[Block]) -> np.ndarray:
        """A row for each block; a page's blocks follow one another."""
        n = len(blocks)
        out = np.zeros((n, INPUTS), np.float32)
        owner: list[int] = []
        buckets: list[int] = []
        numbers = []
        for i, b in enumerate(blocks):
            out[i, : PATH_BUCKETS + LAST_BUCKETS] = self._path(b.path)
            words = b.text.split(" ")
            buckets += map(self._word, words)
            owner.append(len(words))
            size = len(b.text)
            ends = b.text.count(".") + b.text.count("!") + b.text.count("?") + b.text.count(",")
            numbers.append(
                (math.log1p(size) / 8, b.linked / max(1, size), ends / len(words), len(words) / (len(words) + 10), float(b.text[-1] in ".!?…\"”"), min(len(b.path), 12) / 12)
            )
        if n:
            rows = np.repeat(np.arange(n), owner)
            counts = np.bincount(rows * WORD_BUCKETS + np.array(buckets), minlength=n * WORD_BUCKETS).reshape(n, WORD_BUCKETS)
            start = PATH_BUCKETS + LAST_BUCKETS
            out[:, start : start + WORD_BUCKETS] = counts / np.array(owner)[:, None]
            out[:, start + WORD_BUCKETS :] = np.array(numbers)
        return out


State = tuple[np.ndarray, np.ndarray]


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-x))


@dataclass
class BlockLabeller:
    """``inputs, recurrent, bias`` of either direction, and the output layer; gates in the order input, forget, output, cell."""

    weights: dict[str, np.ndarray]

    @classmethod
    def new(cls, rng: np.random.Generator) -> BlockLabeller:
        w: dict[str, np.ndarray] = {}
        for d in ("f", "b"):
            w["inputs_" + d] = rng.normal(0, 1 / math.sqrt(24), (INPUTS, 4 * HIDDEN))
            w["recurrent_" + d] = rng.normal(0, 1 / math.sqrt(HIDDEN), (HIDDEN, 4 * HIDDEN))
            w["bias_" + d] = np.repeat([0.0, 1.0, 0.0, 0.0], HIDDEN)
        w["out"] = rng.normal(0, 1 / math.sqrt(2 * HIDDEN), 2 * HIDDEN)
        w["out_bias"] = np.zeros(1)
        return cls({k: v.astype(np.float32) for k, v in w.items()})

    def _run(self, x: np.ndarray, mask: np.ndarray, d: str, keep: list | None = None, start: State | None = None) -> tuple[np.ndarray, State]:
        """Hidden states of one direction over ``x`` of shape time, page, gates (inputs already weighed), and the state at its end."""
        steps, pages, _ = x.shape
        h, c = start or (np.zeros((pages, HIDDEN), np.float32), np.zeros((pages, HIDDEN), np.float32))
        out = np.zeros((steps, pages, HIDDEN), np.float32)
        recurrent = self.weights["recurrent_" + d]
        for t in range(steps) if d == "f" else range(steps - 1, -1, -1):
            gates = x[t] + h @ recurrent
            s = _sigmoid(gates[:, : 3 * HIDDEN])
            i, f, o = s[:, :HIDDEN], s[:, HIDDEN : 2 * HIDDEN], s[:, 2 * HIDDEN :]
            g = np.tanh(gates[:, 3 * HIDDEN :])
            m = mask[t][:, None]
            new_c = f * c + i * g
            tanh_c = np.tanh(new_c)
            if keep is not None:
                keep.append((t, h, c, i, f, o, g, tanh_c, m))
            c = np.where(m, new_c, c)
            h = np.where(m, o * tanh_c, h)
            out[t] = h
        return out, (h, c)

    def logits(self, x: np.ndarray, mask: np.ndarray, keep: dict | None = None) -> np.ndarray:
        w = self.weights
        states = []
        for d in ("f", "b"):
            weighed = x.reshape(-1, INPUTS) @ w["inputs_" + d] + w["bias_" + d]
            states.append(self._run(weighed.reshape(*x.shape[:2], -1), mask, d, None if keep is None else keep.setdefault(d, []))[0])
        hidden = np.concatenate(states, axis=2)
        if keep is not None:
            keep["hidden"] = hidden
        return hidden @ w["out"] + w["out_bias"]

    def gradients(self, x: np.ndarray, mask: np.ndarray, labels: np.ndarray) -> tuple[float, dict[str, np.ndarray]]:
        """The mean log loss over all blocks, and its gradient by backpropagation through time."""
        w, keep = self.weights, {}
        z = self.logits(x, mask, keep)
        p = _sigmoid(z)
        total = mask.sum()
        loss = float(-(mask * (labels * np.log(p + 1e-9) + (1 - labels) * np.log(1 - p + 1e-9))).sum() / total)
        dz = (p - labels) * mask / total
        grads = {"out": np.einsum("tp,tph->h", dz, keep["hidden"]), "out_bias": np.array([dz.sum()])}
        for n, d in enumerate(("f", "b")):
            from_out = dz[:, :, None] * w["out"][n * HIDDEN : (n + 1) * HIDDEN]
            dx = np.zeros((*x.shape[:2], 4 * HIDDEN), np.float32)
            recurrent = w["recurrent_" + d]
            d_recurrent = np.zeros_like(recurrent)
            dh = np.zeros((x.shape[1], HIDDEN), np.float32)
            dc = np.zeros_like(dh)
            for t, h, c, i, f, o, g, tanh_c, m in reversed(keep[d]):
                dh = dh + from_out[t]
                through = dh * m
                new_dc = dc * m + through * o * (1 - tanh_c**2)
                gate = np.concatenate(
                    (new_dc * g * i * (1 - i), new_dc * c * f * (1 - f), through * tanh_c * o * (1 - o), new_dc * i * (1 - g**2)), axis=1
                )
                dx[t] = gate
                d_recurrent += h.T @ gate
                dh = gate @ recurrent.T + dh * (1 - m)
                dc = new_dc * f + dc * (1 - m)
            flat = dx.reshape(-1, 4 * HIDDEN)
            grads["inputs_" + d] = x.reshape(-1, INPUTS).T @ flat
            grads["recurrent_" + d] = d_recurrent
            grads["bias_" + d] = flat.sum(axis=0)
        return loss, grads

    def fit(self, pages: list[tuple[np.ndarray, np.ndarray]], epochs: int, rate: float, rng: np.random.Generator, at_once: int = 32) -> float:
        """Adam over batches of pages of similar length; returns the last epoch's loss."""
        first = {k: np.zeros_like(v) for k, v in self.weights.items()}
        second = {k: np.zeros_like(v) for k, v in self.weights.items()}
        by_length = sorted(range(len(pages)), key=lambda i: len(pages[i][1]))
        batches = [by_length[i : i + at_once] for i in range(0, len(by_length), at_once)]
        step, mean = 0, 0.0
        for epoch in range(epochs):
            losses = []
            for b in rng.permutation(len(batches)):
                x, mask = padded([pages[i][0] for i in batches[b]])
                labels = np.zeros(mask.shape, np.float32)
                for j, i in enumerate(batches[b]):
                    labels[: len(pages[i][1]), j] = pages[i][1]
                loss, grads = self.gradients(x, mask, labels)
                losses.append(loss)
                step += 1
                for k, g in grads.items():
                    first[k] = 0.9 * first[k] + 0.1 * g
                    second[k] = 0.99 * second[k] + 0.01 * g * g
                    change = rate * (1 - epoch / epochs) * (first[k] / (1 - 0.9**step)) / (np.sqrt(second[k] / (1 - 0.99**step)) + 1e-7)
                    self.weights[k] = (self.weights[k] - change).astype(np.float32)
            mean = float(np.mean(losses))
        return mean

    def label(self, pages: list[np.ndarray], cells: int = CELLS_AT_ONCE) -> list[np.ndarray]:
        """Whether each block of each page is main text; pages of similar length are read together."""
        out: list[np.ndarray] = [np.zeros(0, bool)] * len(pages)
        for group in _side_by_side([len(p) for p in pages], cells):
            z = self.logits(*padded([pages[i] for i in group]))
            for j, i in enumerate(group):
                out[i] = z[: len(pages[i]), j] > 0
        return out

    def label_blocks(self, pages: list[list[Block]], features: Features, cells: int = CELLS_AT_ONCE, at_once: int = BLOCKS_AT_ONCE) -> list[np.ndarray]:
        """``label`` of blocks, with vectors for one group of pages at a time, and for a part of a page of over ``cells`` blocks."""
        out: list[np.ndarray] = [np.zeros(0, bool)] * len(pages)
        for group in _side_by_side([len(p) for p in pages], cells):
            if len(pages[group[0]]) > cells:
                kept = [self.label_long(pages[i], features, at_once) for i in group]
            else:
                everything = features.of([b for i in group for b in pages[i]])
                kept = self.label(np.split(everything, np.cumsum([len(pages[i]) for i in group])[:-1]), cells)
            for i, k in zip(group, kept):
                out[i] = k
        return out

    def label_long(self, blocks: list[Block], features: Features, at_once: int = BLOCKS_AT_ONCE) -> np.ndarray:
        """``label`` of one page read in parts, forward and then backward; each part begins in the state where the one before it ended.

        The whole page counts for each block, but only the vectors of ``at_once`` blocks are held.
        """
        w = self.weights
        z = np.full(len(blocks), w["out_bias"][0], np.float32)
        begins = range(0, len(blocks), at_once)
        for n, d in enumerate(("f", "b")):
            state = None
            for begin in begins if d == "f" else reversed(begins):
                x = features.of(blocks[begin : begin + at_once])
                weighed = (x @ w["inputs_" + d] + w["bias_" + d])[:, None, :]
                hidden, state = self._run(weighed, np.ones(weighed.shape[:2], np.float32), d, start=state)
                z[begin : begin + at_once] += hidden[:, 0] @ w["out"][n * HIDDEN : (n + 1) * HIDDEN]
        return z > 0


def _side_by_side(lengths: list[int], cells: int) -> list[list[int]]:
    """Places of pages of similar length, together of about ``cells`` blocks with their padding; empty pages are left out."""
    order = sorted((i for i, n in enumerate(lengths) if n), key=lambda i: lengths[i])
    groups = []
    while order:
        take = max(1, cells // lengths[order[-1]])
        groups.append(order[-take:])
        del order[-take:]
    return groups


def padded(pages: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Pages side by side: vectors of shape time, page, input, and where they are."""
    steps = max(map(len, pages))
    x = np.zeros((steps, len(pages), INPUTS), np.float32)
    mask = np.zeros((steps, len(pages)), np.float32)
    for j, p in enumerate(pages):
        x[: len(p), j] = p
        mask[: len(p), j] = 1
    return x, mask
