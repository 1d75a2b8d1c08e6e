"""Scalar functions: ``Column -> Column`` builders, all native Spark expressions.

"""

from tejado.functions import contacts, dates, keys, numbers, rules, text  # noqa: F401
