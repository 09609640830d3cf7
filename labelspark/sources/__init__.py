"""Tables: samples, series and sources."""
