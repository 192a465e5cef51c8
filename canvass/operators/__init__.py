from canvass.operators.joins import join_dimension  # noqa: F401
from canvass.operators.existence import reported_precincts, with_existence_flag  # noqa: F401
from canvass.operators.representative import first_row_per_key, pack, unpack  # noqa: F401
from canvass.operators.running import row_positions, running_total  # noqa: F401
from canvass.operators.shares import with_group_total  # noqa: F401
from canvass.operators.topk import top1_per_group  # noqa: F401
