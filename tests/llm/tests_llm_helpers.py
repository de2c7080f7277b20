"""Brute-force versions shared by tests."""

from test_mixing import brute_targets  # noqa: F401
from test_order_minhash import brute_classes  # noqa: F401
from test_packing import check_pieces  # noqa: F401
