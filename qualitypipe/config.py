"""From configuration dicts to frozen dataclasses."""

from __future__ import annotations

import warnings
from collections.abc import Mapping
from dataclasses import fields
from typing import Any, TypeVar

S = TypeVar("S")


def from_config(cls: type[S], config: Mapping[str, Any], ignore: tuple[str, ...] = ()) -> S:
    """Build ``cls`` from the keys it knows; unknown keys are reported and left out, absent or NULL
    ones keep their default."""
    known = {f.name for f in fields(cls)}
    unknown = sorted(set(config) - known - set(ignore))
    if unknown:
        warnings.warn(f"{cls.__name__}: unknown keys ignored: {', '.join(unknown)}", stacklevel=3)
    return cls(**{key: value for key, value in config.items() if key in known and value is not None})
