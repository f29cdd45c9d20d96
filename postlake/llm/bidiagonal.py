"""Leading right singular vectors of a square matrix: Householder reflections make it bidiagonal,
the differential quotient-difference algorithm with shifts (dqds, Fernando and Parlett 1994)
finds its singular values to high relative accuracy, and twisted factorisations (Parlett and
Dhillon 1997) give the vectors. Small dense work for code that runs inside a task."""

import math

import numpy as np

EPS = np.finfo(np.float64).eps
#: A superdiagonal entry is nothing beside values of this relative size (of squares).
NEGLIGIBLE = (10 * EPS) ** 2
#: Squared singular values closer than this, relatively, get their vectors together.
CLOSE = 1e-6
TINY = 1e-150


def bidiagonalise(matrix: np.ndarray):
    """(diagonal, superdiagonal, right reflectors) of U'AV."""
    a = np.array(matrix, np.float64)
    n = len(a)
    reflectors = []

    def reflector(x):
        v = x.copy()
        v[0] += math.copysign(float(np.linalg.norm(x)), x[0])
        length = np.linalg.norm(v)
        return v / length if length else v

    for k in range(n):
        v = reflector(a[k:, k])
        a[k:, k:] -= 2 * np.outer(v, v @ a[k:, k:])
        if k + 2 < n:
            v = reflector(a[k, k + 1 :])
            a[k:, k + 1 :] -= 2 * np.outer(a[k:, k + 1 :] @ v, v)
            reflectors.append(v)
    return np.diag(a).copy(), np.diag(a, 1).copy(), reflectors


def _pair(q1: float, e1: float, q2: float) -> list:
    """Both values of a block of two: no subtraction that could cancel."""
    top = (q1 + q2 + e1 + math.hypot(q1 - q2 + e1, 2 * math.sqrt(q2) * math.sqrt(e1))) / 2
    return [top, q1 * (q2 / top) if top else 0.0]


def _transform(q: list, e: list, shift: float):
    """One dqds step: (q, e) of the shifted block, or the place and value of the first negative."""
    new_q, new_e, d = [], [], q[0] - shift
    for k in range(len(e)):
        if d < 0:
            return None, k, d
        total = d + e[k]
        ratio = q[k + 1] / total if total else 0.0
        new_q.append(total)
        new_e.append(e[k] * ratio)
        d = d * ratio - shift if total else q[k + 1] - shift
    if d < 0:
        return None, len(e), d
    new_q.append(d)
    return new_q, new_e, d


def _least_of_last_two(q: list, e: list) -> float:
    """The lesser value of the last two rows alone: a guess at the least value of the block."""
    upper, lower = q[-2] + (e[-2] if len(e) > 1 else 0.0), q[-1] + e[-1]
    coupling = q[-2] * e[-1]
    top = (upper + lower + math.hypot(upper - lower, 2 * math.sqrt(coupling))) / 2
    return max(0.0, (upper * lower - coupling) / top) if top else 0.0


def dqds(diagonal: np.ndarray, superdiagonal: np.ndarray) -> np.ndarray:
    """Squared singular values of an upper bidiagonal matrix, falling."""
    blocks, out = [([float(x) ** 2 for x in diagonal], [float(x) ** 2 for x in superdiagonal], 0.0)], []
    while blocks:
        q, e, total = blocks.pop()
        fresh = True
        while len(q) > 2:
            if e[-1] <= NEGLIGIBLE * (total + q[-1]):
                out.append(total + q.pop())
                e.pop()
                continue
            split = next((k for k in reversed(range(len(e) - 1)) if e[k] <= NEGLIGIBLE * (total + min(q[k], q[k + 1]))), None)
            if split is not None:
                blocks.append((q[: split + 1], e[:split], total))
                q, e, fresh = q[split + 1 :], e[split + 1 :], True
                continue
            if 1.5 * q[0] < q[-1]:
                q, e = q[::-1], e[::-1]
            # The first step has no shift and moves zeros to the end.
            shift, tries = 0.0 if fresh else _least_of_last_two(q, e), 0
            while True:
                new_q, new_e, d = _transform(q, e, shift)
                if new_q is not None:
                    break
                # A negative in the last place alone leaves an excellent shift.
                late, tries = new_e == len(e), tries + 1
                shift = 0.0 if tries > 3 else max(0.0, (shift + d) * (1 - 4 * EPS)) if late else shift / 4
            q, e, total, fresh = new_q, new_e, total + shift, False
        if len(q) == 2:
            out += [total + x for x in _pair(q[0], e[0], q[1])]
        else:
            out += [total + x for x in q]
    return np.sort(np.array(out))[::-1]


def _twisted(a: list, b: list, value: float) -> np.ndarray:
    """The vector of B'B for one of its values, from the factorisation twisted where it is
    closest to singular."""
    n = len(a)
    ratio = [b[i] / a[i] for i in range(n - 1)]
    floor = EPS * EPS * (value or TINY)
    down, up = [0.0] * (n - 1), [0.0] * (n - 1)
    s = [-value] * n
    for i in range(n - 1):
        pivot = s[i] + a[i] * a[i]
        pivot = pivot if abs(pivot) > floor else floor
        down[i] = a[i] * b[i] / pivot
        s[i + 1] = down[i] * ratio[i] * s[i] - value
    p = a[-1] * a[-1] - value
    gamma = [0.0] * n
    gamma[-1] = s[-1] + p + value
    for i in reversed(range(n - 1)):
        pivot = b[i] * b[i] + p
        pivot = pivot if abs(pivot) > floor else floor
        up[i] = a[i] * b[i] / pivot
        p = p * (a[i] * a[i] / pivot) - value
        gamma[i] = s[i] + p + value
    twist = min(range(n), key=lambda i: abs(gamma[i]))
    z = np.zeros(n)
    z[twist] = 1.0
    for i in reversed(range(twist)):
        z[i] = -down[i] * z[i + 1]
    for i in range(twist, n - 1):
        z[i + 1] = -up[i] * z[i]
    return z / np.linalg.norm(z)


def _together(a: np.ndarray, b: np.ndarray, values: np.ndarray) -> np.ndarray:
    """Orthonormal vectors of values that lie close together, by inverse iteration on all at once."""
    t = np.diag(a * a + np.concatenate([[0.0], b * b])) + np.diag(a[:-1] * b, 1) + np.diag(a[:-1] * b, -1)
    size = float(np.abs(t).max())
    own = t - (values.mean() + 8 * EPS * size) * np.eye(len(t))
    block = np.random.default_rng(5).normal(size=(len(t), len(values)))
    for _ in range(4):
        block = np.linalg.qr(np.linalg.solve(own, block))[0]
    _, turn = np.linalg.eigh(block.T @ t @ block)
    return (block @ turn)[:, ::-1]


def leading_components(r: np.ndarray, k: int):
    """(squared singular values, falling; the first k right singular vectors as rows). The
    largest entry of each vector is positive. A value of 0 has a row of zeros."""
    n = len(r)
    scale = float(np.abs(r).max(initial=0.0))
    if scale == 0.0:
        return np.zeros(n), np.zeros((min(k, n), n))
    a, b, reflectors = bidiagonalise(r / scale)
    values = dqds(a, b)
    # Below this a value is what rounding left of 0.
    values[values <= (n * EPS) ** 2 * values[0]] = 0.0
    a = np.where(np.abs(a) < TINY, TINY, a)
    rows, at, k = np.zeros((min(k, n), n)), 0, min(k, n)
    while at < k and values[at] > 0:
        end = at + 1
        while end < n and values[end - 1] - values[end] <= CLOSE * values[end - 1]:
            end += 1
        if end == at + 1:
            found = _twisted(a.tolist(), b.tolist(), float(values[at]))[:, None]
        else:
            found = _together(a, b, values[at:end])
        for i, v in reversed(list(enumerate(reflectors))):
            found[i + 1 :] -= 2 * np.outer(v, v @ found[i + 1 :])
        rows[at : min(end, k)] = found.T[: min(end, k) - at]
        at = end
    largest = np.abs(rows).argmax(axis=1)
    return values * scale * scale, rows * np.where(rows[np.arange(k), largest] < 0, -1.0, 1.0)[:, None]
