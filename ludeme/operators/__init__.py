"""ludeme.operators"""
