"""The monthly loads, composed from operators for one period."""
