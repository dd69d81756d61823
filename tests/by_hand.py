"""The picker over whole volumes in plain numpy, to compare with."""

import numpy as np
import pandas as pd

from voxframe.kernels import volume as V
from voxframe.operators.aggregates import MAD_SCALE

SCORED = "tomogram_id string, idx long, x double, y double, z double, nx double, ny double, nz double, score double, mean_score double, profile_score double, window int, vesicle_id string, fell_back boolean, kept boolean"


def robust(x: np.ndarray) -> np.ndarray:
    centre = np.median(x)
    scale = MAD_SCALE * np.median(np.abs(x - centre)) or x.std()
    return (x - centre) / scale if scale else np.zeros_like(x)


def by_vesicle(x: np.ndarray, groups: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Each vesicle by its own estimate, the others by that of all; and which those are."""
    out = robust(x)
    for g in np.unique(groups[groups != ""]):
        out[groups == g] = robust(x[groups == g])
    return out, groups == ""


def by_neighbours(x: np.ndarray, points: np.ndarray, radius: float, least: int) -> tuple[np.ndarray, np.ndarray]:
    """By median and MAD of the points within radius, itself among them; with fewer than `least`, or no spread, by those of all."""
    centre = np.median(x)
    whole = MAD_SCALE * np.median(np.abs(x - centre)) or x.std() or 1.0
    out, few = (x - centre) / whole, np.ones(len(x), bool)
    cells = np.floor(points / radius).astype(int)
    _, cell_of = np.unique(cells, axis=0, return_inverse=True)
    for c in range(cell_of.max() + 1 if len(x) else 0):
        own = np.flatnonzero(cell_of == c)
        around = np.flatnonzero((np.abs(cells - cells[own[0]]) <= 1).all(axis=1))
        for i in own:
            near = x[around[((points[around] - points[i]) ** 2).sum(axis=1) <= radius**2]]
            if len(near) >= least:
                middle = np.median(near)
                out[i], few[i] = (x[i] - middle) / (MAD_SCALE * np.median(np.abs(near - middle)) or whole), False
    return out, few


def profile_shape(low: float, high: float, samples: int, width: float | None) -> np.ndarray:
    """A Gaussian about the window's middle without its mean, of unit length; the width is a quarter of the window unless given."""
    about = np.linspace(low, high, samples) - (low + high) / 2
    shape = np.exp(-0.5 * (about / (width or (high - low) / 4 or 1.0)) ** 2)
    shape -= shape.mean()
    return shape / (np.linalg.norm(shape) or 1.0)


def score_surface(tomogram: np.ndarray, segmentation: np.ndarray, voxel: float, s, labels: np.ndarray | None = None, name: str = "") -> pd.DataFrame:
    """All points of both faces with their best window's score; `kept` marks picks."""
    filled = V.fill_membrane(tomogram, segmentation)
    points, normals = V.surface(segmentation)
    cell = np.floor(points / (s.spacing_angstrom / voxel)).astype(int)
    _, first = np.unique(cell, axis=0, return_index=True)
    points, normals = points[np.sort(first)], normals[np.sort(first)]
    margin = s.margin_angstrom / voxel
    inside = ((points >= margin) & (points <= np.array(tomogram.shape) - 1 - margin)).all(axis=1)
    points, normals = points[inside], normals[inside]
    vesicle = np.full(len(points), "", dtype=object)
    if labels is not None:
        if labels.shape != segmentation.shape:
            raise ValueError("vesicle labels have another shape")
        at = np.clip(np.rint(points).astype(int), 0, np.array(labels.shape) - 1)
        vesicle = np.array([f"{name}:v{k:04d}" if k > 0 else "" for k in labels[tuple(at.T)].astype(int)], dtype=object)
    points, normals, vesicle = np.concatenate([points, points]), np.concatenate([normals, -normals]), np.concatenate([vesicle, vesicle])
    if not len(points):
        return pd.DataFrame(columns=[c.split()[0] for c in SCORED.split(", ")])

    def scaled(x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        if s.normalisation == "vesicle" and labels is not None:
            return by_vesicle(x, vesicle)
        if s.normalisation == "local":
            return by_neighbours(x, points, s.local_radius_angstrom / voxel, s.min_local_neighbours)
        return robust(x), np.zeros(len(x), bool)

    sign, means, profiles = (-1.0 if s.dark else 1.0), [], []
    for low, high in s.windows:
        raw = sign * V.sample_along(filled, points, normals, low / voxel, high / voxel, s.samples)
        off = raw - raw.mean(axis=1, keepdims=True)
        norm = np.linalg.norm(off, axis=1)
        along = off @ profile_shape(low, high, s.samples, s.profile_width_angstrom)
        means.append(scaled(raw.mean(axis=1)))
        profiles.append(scaled(np.divide(along, norm, out=np.zeros(len(off)), where=norm > 0)))
    chosen = np.stack([z for z, _ in (means if s.mode == "mean" else profiles)])
    best, here = chosen.argmax(axis=0), np.arange(len(points))
    score = chosen[best, here]
    over = np.flatnonzero(score >= s.threshold)
    kept = np.zeros(len(points), bool)
    if len(over):
        kept[over[suppress(points[over], score[over], s.separation_angstrom / voxel)]] = True
    at_best = lambda found, k: np.stack([x[k] for x in found])[best, here]
    return pd.DataFrame({
        "tomogram_id": name, "idx": here, "x": points[:, 2], "y": points[:, 1], "z": points[:, 0], "nx": normals[:, 2], "ny": normals[:, 1], "nz": normals[:, 0],
        "score": score, "mean_score": at_best(means, 0), "profile_score": at_best(profiles, 0), "window": best.astype("int32"), "vesicle_id": vesicle,
        "fell_back": at_best(means if s.mode == "mean" else profiles, 1), "kept": kept,
    })


def suppress(points, scores, distance):
    """Indices kept greedily, best score first (first of ties), inclusive radius."""
    kept = []
    for i in np.lexsort((np.arange(len(scores)), -scores)):
        if all(((points[i] - points[j]) ** 2).sum() > distance**2 for j in kept):
            kept.append(i)
    return np.sort(np.array(kept, dtype=int))
