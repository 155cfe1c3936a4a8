"""Column expressions. Everything here is built from JVM-side functions, so it stays inside whole-stage codegen."""

from rosterlake.functions import dates, membership, text  # noqa: F401
