"""Parameters of the pipeline, as values of one frozen record."""

from __future__ import annotations

from dataclasses import dataclass


@dataclass(frozen=True)
class Params:
    # Blocking
    max_block: int = 200
    max_pairs: int = 2_000_000
    # Weights of the score
    weight_name: float = 40
    weight_address: float = 15
    weight_postcode: float = 10
    weight_city: float = 5
    weight_phone: float = 15
    weight_email: float = 15
    weight_website: float = 10
    # Name similarity
    alt_name_cap: float = 90
    low_jaccard: float = 0.5
    low_jaccard_cap: float = 70
    # Rarity of shared values
    rare_max: int = 3
    shared_max: int = 10
    shared_factor: float = 0.5
    id_shared_max: int = 3
    # Gates
    auto_score: float = 85
    auto_name: float = 85
    auto_jaccard: float = 0.75
    second_address: float = 85
    review_score: float = 75
    id_conflict_cap: float = 40
    id_conflict_review_name: float = 95
    shared_contact_name: float = 90
    # Clusters and evaluation
    max_rounds: int = 30
    large_cluster: int = 10
    true_id_max: int = 3
    thresholds: tuple[int, ...] = (50, 55, 60, 65, 70, 75, 80, 85, 90, 95)
    # Expected rows of the sources, checked by the run log where given
    expected_raw_charities: int | None = None
    expected_raw_companies: int | None = None
    expected_charities: int | None = None
    expected_companies: int | None = None
