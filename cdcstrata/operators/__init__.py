"""DataFrame-to-DataFrame operators that know nothing about particular tables."""
