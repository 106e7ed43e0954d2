"""The order event stream."""
