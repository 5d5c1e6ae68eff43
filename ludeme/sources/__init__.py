"""ludeme.sources"""
