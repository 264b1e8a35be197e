"""Column helpers shared by the operators (all JVM-side expressions)."""

from demandops.functions.numeric import (  # noqa: F401
    rnd, service_z, safe_div, present, exact_mean, exact_sum,
)
from demandops.functions.windows import (  # noqa: F401
    series_window, strict_rolling, trailing_strict_mean,
)
