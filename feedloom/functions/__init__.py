"""Column builders (no session needed): filter chain, templates, normalisation, dates."""

from .text import lit_str, s, truthy  # noqa: F401
