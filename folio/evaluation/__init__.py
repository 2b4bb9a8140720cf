"""Classification metrics, validation runs and descriptive reports."""
