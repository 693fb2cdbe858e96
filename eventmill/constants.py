"""Event types, topics, thresholds and texts that results must carry."""

# Event types.
ORDER_CREATED = "OrderCreated"
INVENTORY_RESERVED = "InventoryReserved"
INVENTORY_RESERVATION_FAILED = "InventoryReservationFailed"
INVENTORY_RELEASED = "InventoryReleased"
PAYMENT_COMPLETED = "PaymentCompleted"
PAYMENT_FAILED = "PaymentFailed"

# Topics and their partition count.
ORDER_EVENTS = "order.events"
INVENTORY_EVENTS = "inventory.events"
PAYMENT_EVENTS = "payment.events"
TOPIC_PARTITIONS = 3
DLQ_SUFFIX = ".dlq"

# Statuses.
PENDING = "PENDING"
COMPLETED = "COMPLETED"
CANCELLED = "CANCELLED"
PAYMENT_STATUS_COMPLETED = "COMPLETED"
PAYMENT_STATUS_FAILED = "FAILED"

# Reasons.
UNKNOWN_ITEM = "unknown item"
INSUFFICIENT_STOCK = "insufficient stock"
PAYMENT_DECLINED = "simulated payment decline"

# Analytics parameters.
LARGE_ORDER_QUANTITY = 5
COUNT_WINDOW = "1 minute"
COUNT_GRACE = "30 seconds"
JOIN_WINDOW = "5 minutes"
JOIN_GRACE = "1 minute"

# Saga and messaging parameters.
STOCK_SEED = {"widget": 100, "gadget": 50}
UNIT_PRICES = {"widget": 10.0, "gadget": 25.0}
DEFAULT_UNIT_PRICE = 15.0
PAYMENT_FAILURE_RATE = 0.3
MAX_HANDLE_ATTEMPTS = 3
OUTBOX_BATCH_SIZE = 100
CLIENT_REQUESTS_PER_MINUTE = 100
