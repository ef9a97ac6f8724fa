"""Column expressions: text rules, keys, null rules, request/response records."""

from . import constants, nulls, responses, text  # noqa: F401
