"""Writers: tables, extracts, the forecast table and published snapshots."""
