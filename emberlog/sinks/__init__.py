"""Writers: report files, the alert table and the analysis history."""
