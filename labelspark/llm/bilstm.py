"""A character-level bidirectional LSTM with CRF transitions, in numpy: training, marginals and best paths.

The gates are hard sigmoids, clip(x / 4 + 1 / 2, 0, 1), candidates and cells go through x / (1 + |x|): a fraction of the cost of exponentials.

Shapes: n windows of l characters; e numbers per character, h per direction, k labels.
"""

from __future__ import annotations

import numpy as np

KINDS = ("email", "ip", "card", "phone")
#: O, then begin and inside of each kind.
LABELS = ("O", *(f"{p}-{k}" for k in KINDS for p in "BI"))
CHARS = 102  # padding, ASCII, other letters, other characters
SIZES = {"e": 8, "h": 16}
FORBIDDEN = -1e4
#: Gains are sums of some hundred rounded numbers; bounds nearer to nought prove nothing.
SLACK = 1e-2


#: First digits of scripts whose digits are read as ASCII digits; full-width forms of ASCII are read as ASCII as well.
DIGITS_FROM = (0x0660, 0x06F0, 0x0966, 0x09E6)
WIDE, WIDE_END, WIDE_SHIFT = 0xFF01, 0xFF5E, 0xFEE0


def _worked_out(points: np.ndarray) -> np.ndarray:
    """Printable ASCII 1 to 95, line ends 96, other blanks 97, controls 98, other letters 99 to 101 by range."""
    wide = (points >= WIDE) & (points <= WIDE_END)
    points = np.where(wide, points - WIDE_SHIFT, points)
    for first in DIGITS_FROM:
        digit = (points >= first) & (points < first + 10)
        if digit.any():
            points = np.where(digit, points - first + 48, points)
    ids = np.where(points < 0x250, 99, np.where(points < 0x3000, 100, 101)).astype(np.uint8)
    ids = np.where(points < 128, 98, ids)
    printable = (points >= 32) & (points < 127)
    ids[printable] = points[printable] - 31
    ids[(points == 10) | (points == 13)] = 96
    ids[(points == 9) | (points == 160)] = 97
    return ids


#: The ids of the first 65,536 code points, and that of all others.
IDS = _worked_out(np.arange(0x10001, dtype=np.uint32))
PADDING = 0xFFFFFFFF


def char_ids(points: np.ndarray) -> np.ndarray:
    """Padding 0, printable ASCII 1 to 95, line ends 96, other blanks 97, controls 98, other letters 99 to 101 by range."""
    ids = IDS.take(points, mode="clip")
    ids[points == PADDING] = 0
    return ids


def allowed() -> np.ndarray:
    """Transitions: an inside label only follows the begin or inside label of its kind."""
    inside = np.array([name.startswith("I") for name in LABELS])
    kind = np.array([name[2:] for name in LABELS])
    fits = ~inside[None, :] | (kind[:, None] == kind[None, :])
    return np.where(fits, 0.0, FORBIDDEN).astype(np.float32)


def start_scores() -> np.ndarray:
    return np.array([FORBIDDEN if name.startswith("I") else 0.0 for name in LABELS], np.float32)


def initial(seed: int = 0) -> dict[str, np.ndarray]:
    draw = np.random.default_rng(seed)
    e, h, k = SIZES["e"], SIZES["h"], len(LABELS)

    def normal(*shape: int) -> np.ndarray:
        return draw.normal(0, 1 / np.sqrt(shape[0]), shape).astype(np.float32)

    params = {"emb": draw.normal(0, 0.5, (CHARS, e)).astype(np.float32), "out": normal(2 * h, k), "bias": np.zeros(k, np.float32)}
    for way in "fb":
        gates = np.zeros(4 * h, np.float32)
        gates[h : 2 * h] = 1.0  # remember at first
        params |= {f"x{way}": normal(e, 4 * h), f"h{way}": normal(h, 4 * h), f"g{way}": gates}
    return params | {"moves": np.zeros((k, k), np.float32)}


def _gate(x: np.ndarray) -> np.ndarray:
    return np.clip(0.25 * x + 0.5, 0, 1)


def _squash(x: np.ndarray) -> np.ndarray:
    return x / (1 + np.abs(x))


def _walk(pre: np.ndarray, weights: np.ndarray, keep: bool) -> tuple[np.ndarray, list]:
    """One direction over (l, n, 4h) inputs: outputs (l, n, h), and what the way back needs."""
    steps, n, wide = pre.shape
    h = wide // 4
    out, cell, kept = np.zeros((steps, n, h), np.float32), np.zeros((n, h), np.float32), []
    last = np.zeros((n, h), np.float32)
    for t in range(steps):
        z = pre[t] + last @ weights
        gate = _gate(z[:, : 3 * h])
        new = _squash(z[:, 3 * h :])
        before = cell
        cell = gate[:, h : 2 * h] * cell + gate[:, :h] * new
        squashed = _squash(cell)
        last = gate[:, 2 * h :] * squashed
        out[t] = last
        if keep:
            kept.append((gate, new, before, squashed))
    return out, kept


def _walk_back(grad: np.ndarray, out: np.ndarray, kept: list, weights: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Gradients of the inputs (l, n, 4h) and of the recurrent weights."""
    steps, n, h = out.shape
    pre = np.zeros((steps, n, 4 * h), np.float32)
    to_h, to_c = np.zeros((n, h), np.float32), np.zeros((n, h), np.float32)
    for t in reversed(range(steps)):
        gate, new, before, squashed = kept[t]
        enter, stay, show = gate[:, :h], gate[:, h : 2 * h], gate[:, 2 * h :]
        dh = grad[t] + to_h
        dc = to_c + dh * show * (1 - np.abs(squashed)) ** 2
        dz = pre[t]
        slope = 0.25 * ((gate > 0) & (gate < 1))
        dz[:, :h] = dc * new * slope[:, :h]
        dz[:, h : 2 * h] = dc * before * slope[:, h : 2 * h]
        dz[:, 2 * h : 3 * h] = dh * squashed * slope[:, 2 * h :]
        dz[:, 3 * h :] = dc * enter * (1 - np.abs(new)) ** 2
        to_c, to_h = dc * stay, dz @ weights.T
    to_weights = np.einsum("tnh,tng->hg", out[:-1], pre[1:], optimize=True)
    return pre, to_weights


def emissions(params: dict, ids: np.ndarray, keep: list | None = None) -> np.ndarray:
    """Scores (l, n, k) of the labels of windows (n, l)."""
    steps = ids.T
    ways = []
    for way in "fb":
        table = params["emb"] @ params[f"x{way}"] + params[f"g{way}"]
        pre = table[steps if way == "f" else steps[::-1]]
        out, kept = _walk(pre, params[f"h{way}"], keep is not None)
        ways.append(out if way == "f" else out[::-1])
        if keep is not None:
            keep.append((out, kept))
    both = np.concatenate(ways, axis=2)
    if keep is not None:
        keep.append(both)
    return both @ params["out"] + params["bias"]


def scores_of(params: dict, ids: np.ndarray) -> np.ndarray:
    """The scores of `emissions` as (l, k, n): both directions in one loop, all in place, without what training needs.

    What a step reads and writes is to stay in the processor's cache, which a few hundred windows at a time do: outputs are not
    kept but turned into scores by the next step's product.
    """
    h, e, k = SIZES["h"], SIZES["e"], len(LABELS)
    n, steps = ids.shape
    # A quarter and a half of the gates go into the weights; characters and the constant stand below the last outputs.
    share = np.ones((4 * h, 1), np.float32)
    share[: 3 * h] = 0.25
    half = np.zeros((4 * h, 1), np.float32)
    half[: 3 * h] = 0.5
    weights = np.zeros((2, 4 * h + k, h + e + 1), np.float32)
    for w, way in zip("fb", weights, strict=True):
        way[: 4 * h] = np.concatenate([params[f"h{w}"].T, params[f"x{w}"].T, params[f"g{w}"][:, None]], 1) * share
        way[: 4 * h, -1:] += half
    weights[0, 4 * h :, :h], weights[1, 4 * h :, :h] = params["out"][:h].T, params["out"][h:].T
    weights[0, 4 * h :, -1] = params["bias"]
    chars, at = np.ascontiguousarray(params["emb"].T), ids.T.astype(np.intp)
    held = np.zeros((2, h + e + 1, n), np.float32)
    held[:, -1] = 1
    last, next_f, next_b = held[:, :h].transpose(1, 0, 2), held[0, h : h + e], held[1, h : h + e]
    z, cell, new = np.empty((4 * h + k, 2, n), np.float32), np.zeros((h, 2, n), np.float32), np.empty((h, 2, n), np.float32)
    gates, fresh, told = z[: 3 * h], z[3 * h : 4 * h], z[4 * h :]
    out = np.empty((2, steps, k, n), np.float32)
    for t in range(steps + 1):
        if t < steps:
            chars.take(at[t], axis=1, out=next_f, mode="clip")
            chars.take(at[steps - 1 - t], axis=1, out=next_b, mode="clip")
        np.matmul(weights[0], held[0], out=z[:, 0])
        np.matmul(weights[1], held[1], out=z[:, 1])
        if t > 0:
            out[0, t - 1], out[1, steps - t] = told[:, 0], told[:, 1]
        if t == steps:
            break
        np.clip(gates, 0, 1, out=gates)
        np.abs(fresh, out=new)
        new += 1
        fresh /= new
        fresh *= gates[:h]
        cell *= gates[h : 2 * h]
        cell += fresh
        np.abs(cell, out=new)
        new += 1
        np.divide(cell, new, out=new)
        np.multiply(new, gates[2 * h :], out=last)
    return np.add(out[0], out[1], out=out[0])


def may_beat(scores: np.ndarray, moves: np.ndarray) -> np.ndarray:
    """False for windows of (l, k, n) scores in which surely no path scores more than O everywhere; true for all that have one.

    The recursion of best paths with bounds: a span may begin after the best label of all, at the greatest score of a move
    from any label; O counts nothing as long as no path can come back to it with a gain.
    """
    moves = (moves - moves[0, 0]).astype(np.float32)
    first, inner = slice(1, None, 2), slice(2, None, 2)
    m = len(KINDS)
    gains = np.empty((len(scores), 2 * m, scores.shape[2]), np.float32)  # begins, then insides
    np.subtract(scores[:, first], scores[:, :1], out=gains[:, :m])
    np.subtract(scores[:, inner], scores[:, :1], out=gains[:, m:])
    from_o, from_any = moves[0, first][:, None], moves[1:, first].max(axis=0)[:, None]
    onward = np.concatenate([np.diagonal(moves[part, inner]) for part in (first, inner)])[:, None]
    best = gains[0].copy()
    best[m:] += FORBIDDEN
    most = best.max(axis=0)
    peak, ways = most.copy(), np.empty_like(best)
    begin, inside = best[:m], best[m:]
    for gain in gains[1:]:
        np.add(best, onward, out=ways)
        np.maximum(ways[:m], ways[m:], out=inside)
        np.add(most, from_any, out=begin)
        np.maximum(begin, from_o, out=begin)
        best += gain
        np.maximum.reduce(best, axis=0, out=most)
        np.maximum(peak, most, out=peak)
    return peak + max(0.0, moves[1:, 0].max()) > -SLACK


def beats(scores: np.ndarray, moves: np.ndarray, at_once: int = 512) -> np.ndarray:
    """True for the windows of (l, k, n) scores in which some path scores more than O everywhere.

    The recursion of best paths, over gains against O and without ways back; a few windows at a time, so that all stays in
    the processor's cache.
    """
    moves = (moves - moves[0, 0]).astype(np.float32)
    first, inner = slice(1, None, 2), slice(2, None, 2)
    into = [(j, np.ascontiguousarray(moves[:, j])[:, None]) for j in (0, *range(1, len(LABELS), 2))]
    from_first, from_inner = (np.diagonal(moves[part, inner]).copy()[:, None] for part in (first, inner))
    found = np.empty(scores.shape[2], bool)
    for at in range(0, scores.shape[2], at_once):
        part = scores[:, :, at : at + at_once]
        gains = part - part[:, :1]
        best = gains[0] + start_scores()[:, None]
        after, ways, more = np.empty_like(best), np.empty_like(best), np.empty_like(best[first])
        for t in range(1, len(gains)):
            for j, column in into:
                np.add(best, column, out=ways)
                np.maximum.reduce(ways, axis=0, out=after[j])
            np.add(best[first], from_first, out=more)
            np.add(best[inner], from_inner, out=after[inner])
            np.maximum(after[inner], more, out=after[inner])
            after += gains[t]
            best, after = after, best
        found[at : at + at_once] = best.max(axis=0) > 0
    return found


def _logsum(x: np.ndarray, axis: int) -> np.ndarray:
    most = x.max(axis=axis, keepdims=True)
    return np.squeeze(most, axis) + np.log(np.exp(x - most).sum(axis=axis))


def forward_backward(scores: np.ndarray, moves: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Log sums of the ways to and from each label (l, n, k), and the whole log sums (n)."""
    to, back = np.zeros_like(scores), np.zeros_like(scores)
    to[0] = scores[0] + start_scores()
    for t in range(1, len(scores)):
        to[t] = _logsum(to[t - 1][:, :, None] + moves, 1) + scores[t]
    for t in reversed(range(len(scores) - 1)):
        back[t] = _logsum(moves + (scores[t + 1] + back[t + 1])[:, None, :], 2)
    return to, back, _logsum(to[-1], 1)


def gradients(params: dict, ids: np.ndarray, gold: np.ndarray) -> tuple[float, dict[str, np.ndarray]]:
    """Mean negative log likelihood of the gold labels (n, l) and its gradients."""
    kept: list = []
    scores = emissions(params, ids, kept)
    moves = params["moves"] + allowed()
    to, back, whole = forward_backward(scores, moves)
    n, (steps, _, k) = len(ids), scores.shape
    labels = gold.T
    rows = np.arange(n)
    path = start_scores()[labels[0]] + sum(scores[t, rows, labels[t]] for t in range(steps))
    path = path + sum(moves[labels[t], labels[t + 1]] for t in range(steps - 1))
    slope = np.exp(to + back - whole[None, :, None])
    for t in range(steps):
        slope[t, rows, labels[t]] -= 1
    pairs = np.zeros((k, k), np.float32)
    for t in range(steps - 1):
        both = to[t][:, :, None] + moves + (scores[t + 1] + back[t + 1])[:, None, :] - whole[:, None, None]
        pairs += np.exp(both).sum(axis=0)
    np.subtract.at(pairs, (labels[:-1].ravel(), labels[1:].ravel()), 1)
    slope /= n
    both = kept[2]
    found = {"moves": pairs / n, "out": np.einsum("tnh,tnk->hk", both, slope, optimize=True), "bias": slope.sum(axis=(0, 1))}
    to_both = slope @ params["out"].T
    h = SIZES["h"]
    to_emb = np.zeros_like(params["emb"])
    for way, (out, states), part in zip("fb", kept[:2], (to_both[:, :, :h], to_both[::-1, :, h:]), strict=True):
        pre, to_weights = _walk_back(part, out, states, params[f"h{way}"])
        seen = (ids.T if way == "f" else ids.T[::-1]).ravel()
        by_char = np.zeros((CHARS, 4 * h), np.float32)
        np.add.at(by_char, seen, pre.reshape(-1, 4 * h))
        found |= {f"h{way}": to_weights, f"x{way}": params["emb"].T @ by_char, f"g{way}": by_char.sum(axis=0)}
        to_emb += by_char @ params[f"x{way}"].T
    return float((whole - path).mean()), found | {"emb": to_emb}


def train(ids: np.ndarray, gold: np.ndarray, *, epochs: int = 5, batch: int = 64, rate: float = 0.02, seed: int = 0) -> dict[str, np.ndarray]:
    """Adam over shuffled batches, the same for the same windows; gradients are cut to length 5."""
    params, draw, step = initial(seed), np.random.default_rng(seed), 0
    first = {k: np.zeros_like(v) for k, v in params.items()}
    second = {k: np.zeros_like(v) for k, v in params.items()}
    total = epochs * -(-len(ids) // batch)
    for _ in range(epochs):
        order = draw.permutation(len(ids))
        for at in range(0, len(order), batch):
            part = order[at : at + batch]
            _, found = gradients(params, ids[part], gold[part])
            length = np.sqrt(sum(float((g**2).sum()) for g in found.values()))
            step += 1
            speed = rate * (1 - 0.9 * step / total)
            for name, g in found.items():
                g = g * min(1.0, 5 / (length + 1e-9))
                first[name] = 0.9 * first[name] + 0.1 * g
                second[name] = 0.99 * second[name] + 0.01 * g**2
                mean, spread = first[name] / (1 - 0.9**step), second[name] / (1 - 0.99**step)
                params[name] = (params[name] - speed * mean / (np.sqrt(spread) + 1e-6)).astype(np.float32)
    return params


def best_paths(params: dict, ids: np.ndarray, at_once: int = 512, decode_at_once: int = 2048) -> tuple[np.ndarray, np.ndarray]:
    """Most likely labels (n, l) of windows and the probability of each label where it stands (1 for windows all O).

    Most windows are all O, which `may_beat` and `beats` prove; only the others are decoded, together.
    """
    moves = params["moves"] + allowed()
    labels, sure = np.zeros(ids.shape, np.int64), np.ones(ids.shape, np.float32)
    places, left = [], []

    def decode() -> None:
        scores = np.concatenate(left, axis=2)
        proven = beats(scores, moves)
        some = np.concatenate(places)[proven]
        scores = np.ascontiguousarray(scores[:, :, proven].transpose(0, 2, 1))
        places.clear()
        left.clear()
        if not len(some):
            return
        labels[some] = decoded(scores, moves)
        to, back, whole = forward_backward(scores, moves)
        odds = np.exp(to + back - whole[None, :, None])
        sure[some] = np.take_along_axis(odds, labels[some].T[:, :, None], 2)[:, :, 0].T

    for at in range(0, len(ids), at_once):
        scores = scores_of(params, ids[at : at + at_once])
        some = np.flatnonzero(may_beat(scores, moves))
        if len(some):
            places.append(at + some)
            left.append(scores[:, :, some])
        if sum(map(len, places)) >= decode_at_once:
            decode()
    if places:
        decode()
    return labels, sure


def decoded(scores: np.ndarray, moves: np.ndarray) -> np.ndarray:
    """The labels (n, l) of the best path of each window of (l, n, k) scores."""
    steps, n, k = scores.shape
    best, came = scores[0] + start_scores(), np.zeros((steps, n, k), np.int8)
    for t in range(1, steps):
        ways = best[:, :, None] + moves
        came[t] = ways.argmax(axis=1)
        best = np.take_along_axis(ways, came[t][:, None, :].astype(np.int64), 1)[:, 0] + scores[t]
    labels = np.zeros((n, steps), np.int64)
    labels[:, -1] = best.argmax(axis=1)
    rows = np.arange(n)
    for t in reversed(range(1, steps)):
        labels[:, t - 1] = came[t, rows, labels[:, t]]
    return labels
