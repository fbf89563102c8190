"""Column expressions shared by the plans (all native Catalyst, no UDFs)."""

from hazrank.functions.columns import (  # noqa: F401
    conditional_count, conditional_ratio, flag_yn, pounds_exact, to_pounds,
)
