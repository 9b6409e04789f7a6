"""Import every module that registers queries."""

import lakeops.plans.fraud  # noqa: F401
import lakeops.plans.secure  # noqa: F401
import lakeops.plans.lake  # noqa: F401
import lakeops.plans.business  # noqa: F401
import lakeops.plans.fleet  # noqa: F401
import lakeops.plans.text  # noqa: F401
import lakeops.plans.files  # noqa: F401
import lakeops.plans.streams  # noqa: F401
