"""Where records, readings and lookups come from, and where bookings go."""
