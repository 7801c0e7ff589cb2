"""Table and stream jobs around a classifier over booking-like records, on Spark."""
