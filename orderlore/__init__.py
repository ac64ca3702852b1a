"""orderlore: order-history analytics and cancellation modelling on Spark."""
