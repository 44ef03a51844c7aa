"""Training-data pipeline operators (token counts to packing); nothing outside this package imports it."""
