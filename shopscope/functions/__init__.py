from shopscope.functions.exact import money, money_even, ratio  # noqa: F401
from shopscope.functions.calendar import (elapsed_days, month_label, month_ordinal,  # noqa: F401
                                          ordinal_label)
