"""Deterministic keys computed inside the JVM."""

from __future__ import annotations

import uuid

from pyspark.sql import Column
from pyspark.sql import functions as F


def uuid5(*parts: Column, namespace: uuid.UUID = uuid.NAMESPACE_X500) -> Column:
    """RFC 4122 version-5 UUID of the concatenated ``parts``.

    Equal to ``str(uuid.uuid5(namespace, "".join(parts)))``; NULL when a part
    is NULL.
    """
    name = F.encode(F.concat(*[p.cast("string") for p in parts]), "UTF-8")
    digest = F.sha1(F.concat(F.unhex(F.lit(namespace.hex)), name))
    # The digest is bound to a variable: named in six places of one expression it was made six times
    # over, and 36 times where a key is part of another one.
    return F.transform(F.array(digest), _uuid_text)[0]


def _uuid_text(digest: Column) -> Column:
    """The hex digest as a version-5 UUID."""
    # Two top bits of the 17th hex digit become binary 10 (the RFC variant).
    variant = F.translate(F.substring(digest, 17, 1), "0123456789abcdef", "89ab89ab89ab89ab")
    return F.concat(
        F.substring(digest, 1, 8),
        F.lit("-"),
        F.substring(digest, 9, 4),
        F.lit("-5"),
        F.substring(digest, 14, 3),
        F.lit("-"),
        variant,
        F.substring(digest, 18, 3),
        F.lit("-"),
        F.substring(digest, 21, 12),
    )


def hash_key(*parts: Column) -> Column:
    """64-bit hash key of a hub or link; NULL if any part is NULL."""
    complete = parts[0].isNotNull()
    for part in parts[1:]:
        complete = complete & part.isNotNull()
    return F.when(complete, F.xxhash64(*parts))
