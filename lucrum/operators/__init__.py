"""DataFrame -> DataFrame operators."""
from .allocate import allocate  # noqa: F401
from .combine import union_batches  # noqa: F401
from .dedup import keep_first, latest_per_key, rank_latest  # noqa: F401
from .lookup import month_lookup  # noqa: F401
from .margin import line_amounts, net_margin  # noqa: F401
from .nested import explode_rows, first_match, first_with, project, stringify  # noqa: F401
from .paging import page, page_after  # noqa: F401
from .sizing import broadcast_if_bounded, measured_bytes  # noqa: F401
from .upsert import merge  # noqa: F401
