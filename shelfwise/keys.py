"""Column groups shared by the operators."""

PAIR = ["cmid", "foreign_store_id", "foreign_item_id"]
DAY = PAIR + ["date"]
STORE = ["cmid", "foreign_store_id"]
ITEM = ["cmid", "foreign_item_id"]

# Fixed values of the source systems.
HEADQUARTERS_STORE = "1000000"
DISCONTINUED_STATUSES = ["淘汰", "淘汰品"]
CLOSED_STATUS = "闭店"
CENTRAL_DELIVERY = "统配出"
RETURNED_CAUSE = "退货"
STORE_MANAGER_MARK = "店长"
