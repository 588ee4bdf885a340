"""tickhouse.sources"""
