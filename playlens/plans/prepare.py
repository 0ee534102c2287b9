"""Preparation jobs: catalog + plays -> item ids -> scores -> labelled split.

Each job variant of the workload is one call here; they differ only in
the score scale, the zero handling and the split fraction:

=================  =====  ===============  ========
variant            scale  zeros            fraction
=================  =====  ===============  ========
``x100``           100    kept             0.8
``x1``             1      kept             0.8
``x10``            10     dropped after    0.8
``raw_share``      --     dropped after    0.8
``positive_70``    100    dropped before   0.7
=================  =====  ===============  ========
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from playlens.operators.ids import build_item_ids, rekey
from playlens.operators.ratings import minmax_score, play_share
from playlens.operators.split import DEFAULT_SEED, split_per_user
from playlens.sources.sinks import write_split, write_table
from playlens.sources.tables import read_parquet

# Scores and shares have one row for each of these.
PAIR = ["user_id", "track_new_id"]


def rekeyed_plays(tracks: DataFrame, interactions: DataFrame, num_partitions: int | None = None) -> DataFrame:
    """Plays with dense item ids (NULL where the catalog has no row)."""
    return rekey(interactions, build_item_ids(tracks, num_partitions=num_partitions))


def scores(
    tracks: DataFrame,
    interactions: DataFrame,
    scale: float = 100.0,
    zeros: str = "keep",
    num_partitions: int | None = None,
) -> DataFrame:
    """``(user_id, track_new_id, ranking, normalized_ranking)``."""
    return minmax_score(rekeyed_plays(tracks, interactions, num_partitions), scale=scale, zeros=zeros)


def labelled_split(
    scored: DataFrame,
    fraction: float = 0.8,
    zeros: str = "keep",
    seed: int = DEFAULT_SEED,
    score_col: str = "normalized_ranking",
) -> DataFrame:
    """Split scored rows (unique pairs) per user; ``zeros="drop_after"`` removes score-0 rows afterwards."""
    out = split_per_user(scored, fraction, seed, unique_by=PAIR)
    if zeros == "drop_after":
        out = out.where(F.col(score_col) > 0)
    return out


def share_table(tracks: DataFrame, interactions: DataFrame) -> DataFrame:
    """``(user_id, track_new_id, ranking)``: the share itself as rating."""
    return play_share(rekeyed_plays(tracks, interactions)).select("user_id", "track_new_id", "ranking")


def raw_share_split(shares: DataFrame, fraction: float = 0.8, seed: int = DEFAULT_SEED) -> DataFrame:
    """Split all rows of a ``share_table``, then keep positive shares.

    Pairs without an item (share 0) and users with only unmatched plays
    (share NULL) take part in the split threshold but are not kept.
    """
    return split_per_user(shares, fraction, seed, unique_by=PAIR).where(F.col("ranking") > 0)


VARIANTS = {
    "x100": dict(scale=100.0, zeros="keep", fraction=0.8),
    "x1": dict(scale=1.0, zeros="keep", fraction=0.8),
    "x10": dict(scale=10.0, zeros="drop_after", fraction=0.8),
    "positive_70": dict(scale=100.0, zeros="drop_before", fraction=0.7),
}


def prepare(
    tracks: DataFrame, interactions: DataFrame, variant: str = "x100", seed: int = DEFAULT_SEED
) -> DataFrame:
    """Scored rows with a ``dataset`` label for one named variant."""
    if variant == "raw_share":
        return raw_share_split(share_table(tracks, interactions), seed=seed)
    v = VARIANTS[variant]
    scored = scores(tracks, interactions, scale=v["scale"], zeros=v["zeros"])
    return labelled_split(scored, v["fraction"], zeros=v["zeros"], seed=seed)


def run_preparation(
    tracks: DataFrame,
    interactions: DataFrame,
    out_dir: str,
    variant: str = "x100",
    seed: int = DEFAULT_SEED,
    mode: str = "errorifexists",
) -> dict[str, str]:
    """Write the score table and the labelled split of one variant.

    The split is one write partitioned by ``dataset`` (train and validation
    can never overlap or miss rows).  The score (or share) table is written
    first and the split is computed from the written table, so the chain
    runs once and the written table cuts the lineage.
    """
    paths = {"split": f"{out_dir}/split", "scores": f"{out_dir}/scores"}
    if variant == "raw_share":
        write_table(share_table(tracks, interactions), paths["scores"], mode=mode)
        shares = read_parquet(tracks.sparkSession, paths["scores"])
        write_split(raw_share_split(shares, seed=seed), paths["split"], mode=mode)
        return paths
    v = VARIANTS[variant]
    scored = scores(tracks, interactions, scale=v["scale"], zeros=v["zeros"])
    write_table(scored, paths["scores"], mode=mode)
    scored = read_parquet(tracks.sparkSession, paths["scores"])
    write_split(labelled_split(scored, v["fraction"], zeros=v["zeros"], seed=seed), paths["split"], mode=mode)
    return paths
