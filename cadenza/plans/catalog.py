"""Import every query module so the registry is complete."""

from cadenza.plans import q_artists, q_interactions, q_models, q_playlist, q_profiles, q_scoring, q_text  # noqa: F401
from cadenza.plans.registry import ORACLES, QUERIES

__all__ = ["QUERIES", "ORACLES"]
