"""Driver binding: the library's operators applied to the driver's tables."""

from trustfold.bindings.registry import REGISTRY


def load_all() -> dict:
    """Import every query module so that all queries are registered."""
    from trustfold.bindings import q_features, q_operators, q_profile, q_publish, q_sketches, q_trusted  # noqa: F401

    return REGISTRY
