"""Joint assignment of the segments that a crossing split to the identities seen before it."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame

from .sequence import assignment_margin

LINKS = "shot_no long, pred long, succ long, belief double, place long"


def _groups(rows: pd.DataFrame) -> list[tuple[int, tuple[int, ...], list[int]]]:
    """(split frame, candidate tracks, segment tracks), in the order of each group's first segment."""
    found: dict[tuple, list[int]] = {}
    for r in rows[rows["split_frame"].notna()].itertuples():
        found.setdefault((int(r.split_frame), tuple(sorted(int(c) for c in r.cands))), []).append(int(r.track_id))
    return [(frame, cands, tracks) for (frame, cands), tracks in found.items()]


def link_shot(rows: pd.DataFrame, least: float) -> list[tuple[int, int, float]]:
    """(pred, succ, belief) of one shot; each accepted group joins its segments to identities, which later groups see."""
    rows = rows.sort_values(["start_frame", "track_id"])
    at = {int(r.track_id): r for r in rows.itertuples()}
    vector = {t: np.asarray(r.emb, float) for t, r in at.items() if r.emb is not None}
    identity = {t: t for t in at}
    links = []
    for frame, cands, tracks in _groups(rows):
        before = [c for c in cands if c in vector and c not in tracks and at[c].end_frame <= frame]
        roots = list(dict.fromkeys(identity[c] for c in before))
        asked = [t for t in tracks if t in vector]
        if not roots or not asked:
            continue
        members = {r: [t for t in at if identity[t] == r] for r in roots}
        anchors = []
        for r in roots:
            v = sum(vector[t] * at[t].n_frames for t in members[r] if t in vector)
            anchors.append(v / (np.linalg.norm(v) + 1e-9))
        pairs, margin = assignment_margin(np.array([[vector[t] @ a for a in anchors] for t in asked]))
        if margin < least:
            continue
        for i, k in pairs:
            ended = [t for t in members[roots[k]] if at[t].end_frame <= frame]
            if ended:
                pred = max(ended, key=lambda t: at[t].end_frame)
                links.append((pred, asked[i], float(np.clip(0.6 + 4 * margin, 0.6, 0.98))))
                joined = identity[asked[i]]
                identity |= {t: identity[pred] for t in at if identity[t] == joined}
    return links


def link_splits(tracklets: DataFrame, least: float = 0.03) -> DataFrame:
    """tracklets (shot_no, track_id, start_frame, end_frame, n_frames, emb, split_frame, cands) -> shot_no, pred, succ, belief
    and the link's place in the order of a shot's decisions.

    emb may be null (takes no part), as may split_frame (not a segment). Groups of one shot depend on one another, so a
    shot is one task's work; its tracklets are a few hundred rows.
    """

    def run(rows: pd.DataFrame) -> pd.DataFrame:
        shot = int(rows["shot_no"].iloc[0])
        return pd.DataFrame([(shot, *x, k) for k, x in enumerate(link_shot(rows, least))], columns=["shot_no", "pred", "succ", "belief", "place"])

    columns = ["shot_no", "track_id", "start_frame", "end_frame", "n_frames", "emb", "split_frame", "cands"]
    return tracklets.select(*columns).filter("shot_no IS NOT NULL").groupBy("shot_no").applyInPandas(run, LINKS)
